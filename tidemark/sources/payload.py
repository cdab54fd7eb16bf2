"""Transaction payloads: tolerant XML record scan (A5) and JSON documents.

Both formats are parsed once into one normalised transaction struct, so the
transaction, item and payment models read the same typed columns (nested
column pruning keeps each model's scan narrow).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import config as C

S = T.StringType()


def _struct(*fields):
    return T.StructType([f if isinstance(f, T.StructField) else T.StructField(f, S) for f in fields])


# <Transaction> record as the XML reader sees it. Unknown extra elements
# (loyalty tier, tags, notes, warranty, ...) are simply not in the schema.
XML_TRANSACTION_SCHEMA = _struct(
    "TransactionID",
    T.StructField("Order", _struct(
        "OrderID", "OrderDate",
        T.StructField("Customer", _struct(
            "CustomerID",
            T.StructField("Name", _struct("FirstName", "LastName", "LastLastName")),
            "Email")))),
    T.StructField("Items", _struct(
        T.StructField("Item", T.ArrayType(_struct(
            "SKU", "Description", "Quantity",
            T.StructField("UnitPrice", _struct("_VALUE", "_currency"))))))),
    T.StructField("Payment", _struct(
        "Method",
        T.StructField("Amount", _struct("_VALUE", "_currency")),
        T.StructField("Fees", _struct("ProcessingFee")))),
)

JSON_ITEM_SCHEMA = _struct("sku", "description", "qty", T.StructField("price", _struct("amount", "currency")))
JSON_TRANSACTION_SCHEMA = _struct(
    "id",
    T.StructField("order", _struct("id", "date", T.StructField("customer", _struct("id", "name", "email")))),
    T.StructField("items", T.ArrayType(JSON_ITEM_SCHEMA)),
    T.StructField("payment", _struct("method", "total", "currency")),
)
JSON_DOCUMENT_SCHEMA = _struct("client", "batchTimestamp",
                               T.StructField("transactions", T.ArrayType(JSON_TRANSACTION_SCHEMA)))

XML_RECORD_SEPARATOR = "</Transaction>"
_LAST_OPENING_TAG = r"(?s).*(<Transaction[\s>].*)$"


def xml_record(chunk) -> F.Column:
    """The record that ends a chunk, with its closing tag; NULL without an opening tag."""
    rec = F.regexp_extract(chunk, _LAST_OPENING_TAG, 1)
    return F.when(rec != F.lit(""), F.concat(rec, F.lit(XML_RECORD_SEPARATOR)))


def xml_chunks(text) -> F.Column:
    """A whole XML text -> its chunks, cut as the files are when read with `lineSep='</Transaction>'`."""
    return F.split(text, XML_RECORD_SEPARATOR, -1)


def xml_records(chunks: DataFrame, text_col: str = "value") -> DataFrame:
    """Text chunks split at `</Transaction>` -> one complete record per row.

    Each chunk holds at most one record, preceded by whatever came before it in
    the file (banner, root element, comments). The record starts at the *last*
    opening tag, so a tag mentioned in an earlier comment does not confuse it.
    Chunks without an opening tag (the file tail) are dropped.
    """
    return chunks.withColumn("raw_payload", xml_record(F.col(text_col))).filter(F.col("raw_payload").isNotNull()).drop(text_col)


def split_xml_text(files: DataFrame, text_col: str = "text") -> DataFrame:
    """Whole XML texts in a column -> chunks with their position in the file.

    Same cut as reading the files with `lineSep='</Transaction>'`; used when
    the documents are already in a DataFrame.
    """
    return (files.select("*", F.posexplode(xml_chunks(F.col(text_col)))
                         .alias("_row_pos", "value"))
            .drop(text_col))


def clean_json_document(c) -> F.Column:
    """Remove banner lines around a JSON document; `//` comments stay for the parser."""
    return F.regexp_replace(c, C.BANNER_LINE_PATTERN, "")


JSON_OPTIONS = {"allowComments": "true", "mode": "PERMISSIVE"}
XML_OPTIONS = {"mode": "PERMISSIVE"}


def is_xml_record(c) -> F.Column:
    """Whether the text is one well-formed record: the parser's error column stays empty."""
    schema = T.StructType([*XML_TRANSACTION_SCHEMA.fields, T.StructField("_corrupt", T.StringType())])
    return F.from_xml(c, schema, {**XML_OPTIONS, "columnNameOfCorruptRecord": "_corrupt"})["_corrupt"].isNull()


def is_json_document(c) -> F.Column:
    """Whether the text is one JSON object with a list of transactions."""
    schema = T.StructType([*JSON_DOCUMENT_SCHEMA.fields, T.StructField("_corrupt", T.StringType())])
    d = F.from_json(clean_json_document(c), schema, {**JSON_OPTIONS, "columnNameOfCorruptRecord": "_corrupt"})
    return d["_corrupt"].isNull() & d["transactions"].isNotNull()


def _xml_txn(p) -> F.Column:
    cust = p["Order"]["Customer"]
    return F.struct(
        p["TransactionID"].alias("txn_id"),
        p["Order"]["OrderID"].alias("order_id"),
        p["Order"]["OrderDate"].alias("order_date"),
        cust["CustomerID"].alias("customer_id"),
        cust["Name"]["FirstName"].alias("first_name"),
        # drifting element names: <LastName>, else <LastLastName>
        F.coalesce(F.nullif(F.trim(cust["Name"]["LastName"]), F.lit("")),
                   cust["Name"]["LastLastName"]).alias("last_name"),
        F.lit(None).cast("string").alias("customer_name"),
        cust["Email"].alias("email"),
        p["Payment"]["Method"].alias("payment_method"),
        p["Payment"]["Amount"]["_VALUE"].alias("amount"),
        p["Payment"]["Amount"]["_currency"].alias("currency"),
        p["Payment"]["Fees"]["ProcessingFee"].alias("processing_fee"),
    )


def _xml_items(p) -> F.Column:
    return F.transform(p["Items"]["Item"], lambda i: F.struct(
        i["SKU"].alias("sku"), i["Description"].alias("description"),
        i["Quantity"].alias("qty"), i["UnitPrice"]["_VALUE"].alias("price"),
        i["UnitPrice"]["_currency"].alias("currency")))


def _json_txn(t) -> F.Column:
    return F.struct(
        t["id"].alias("txn_id"),
        t["order"]["id"].alias("order_id"),
        t["order"]["date"].alias("order_date"),
        t["order"]["customer"]["id"].alias("customer_id"),
        F.lit(None).cast("string").alias("first_name"),
        F.lit(None).cast("string").alias("last_name"),
        t["order"]["customer"]["name"].alias("customer_name"),
        t["order"]["customer"]["email"].alias("email"),
        t["payment"]["method"].alias("payment_method"),
        t["payment"]["total"].alias("amount"),
        t["payment"]["currency"].alias("currency"),
        F.lit(None).cast("string").alias("processing_fee"),
    )


def _json_items(t) -> F.Column:
    return F.transform(t["items"], lambda i: F.struct(
        i["sku"].alias("sku"), i["description"].alias("description"),
        i["qty"].alias("qty"), i["price"]["amount"].alias("price"),
        i["price"]["currency"].alias("currency")))


_KEEP = ("client_id", "_source_file", "_loaded_at", "_split_start", "_row_pos")


def parse_transactions(raw: DataFrame) -> DataFrame:
    """RAW transactions (text payloads) -> one row per transaction.

    Output: client_id, lineage columns, `_txn_pos` (index inside a JSON
    document, 0 for XML records), `fmt`, `txn` (normalised struct) and
    `items` (array of normalised item structs; NULL when absent/empty).
    The XML branch and the JSON branch each see only their own clients, so a
    RAW table partitioned by client_id is pruned per branch.
    """
    keep = [c for c in (*_KEEP, "_batch") if c in raw.columns]
    fmt = {s.client_id: s.fmt for s in C.PAYLOAD_SOURCES}
    xml_clients = [c for c, f in fmt.items() if f == "xml"]
    json_clients = [c for c, f in fmt.items() if f in ("json", "jsonl", "jsonarray")]

    xml = (raw.filter(F.col("client_id").isin(*xml_clients))
           .select(*keep, F.from_xml("raw_payload", XML_TRANSACTION_SCHEMA, XML_OPTIONS).alias("p"))
           .select(*keep, F.lit(0).cast("bigint").alias("_txn_pos"), F.lit("xml").alias("fmt"),
                   _xml_txn(F.col("p")).alias("txn"), _xml_items(F.col("p")).alias("items")))

    docs = (raw.filter(F.col("client_id").isin(*json_clients))
            .select(*keep, F.from_json(clean_json_document(F.col("raw_payload")),
                                        JSON_DOCUMENT_SCHEMA, JSON_OPTIONS).alias("d")))
    # One document -> one row per transaction; the document keeps its own
    # position in the file and `_txn_pos` orders the transactions inside it.
    js = (docs.select(*keep, F.posexplode("d.transactions").alias("_txn_pos", "t"))
          .select(*keep, F.col("_txn_pos").cast("bigint"), F.lit("json").alias("fmt"),
                  _json_txn(F.col("t")).alias("txn"), _json_items(F.col("t")).alias("items")))
    return xml.unionByName(js)
