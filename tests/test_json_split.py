"""JSON documents cut across splits: the rows equal those of the whole text, wherever the borders fall."""
import json
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.config import PayloadSource
from tidemark.sources import json_split as J
from tidemark.sources.files import read_payload_source

SOURCE = PayloadSource("client_c", "client_c/", r"(?i).*transaction.*\.json$", "jsonarray")
NOTES = ["plain", "a } brace", "{ [ ] }", "quote \" and \\ back", "it's // no comment", "/* no } comment */", "}", "\\", "\n}"]


def document(n, indent=None, extra=""):
    records = [{"id": f"T{i}", "note": NOTES[i % len(NOTES)] * (1 + i % 3), "order": {"id": f"O{i}", "customer": {"id": str(i), "name": "}{"}},
                "items": [{"sku": f"S{k}", "price": {"amount": "1", "currency": "EUR"}} for k in range(i % 3)]} for i in range(n)]
    head = {"client": "C }", "tags": [{"id": "no record"}], "batchTimestamp": "2025"}
    text = json.dumps({**head, "transactions": records, "totals": {"list": [{"id": "no record"}]}}, indent=indent)
    text = text.replace('{"id": "T', '{ /* } ] " */ "id": "T').replace('"transactions": ', '"transactions": // the { list\n ')
    return f"----- START OF FILE: it's.json -----\n// an { '{' } in a comment \"\n{text}\n{extra}// end }}\n----- END OF FILE -----\n", records


def files(spark, root, texts):
    os.makedirs(f"{root}/client_c", exist_ok=True)
    for name, text in texts.items():
        with open(f"{root}/client_c/Transactions_{name}.json", "w", newline="") as f:
            f.write(text)
    return read_payload_source(spark, root, SOURCE, "2025-01-01 00:00:00")


def loaded(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r["_source_file"], r["_split_start"], r["_row_pos"])):
        text = r["raw_payload"].replace('/* } ] " */', "")
        out.setdefault(r["_source_file"], []).extend(json.loads(text)["transactions"])
    return out


@pytest.mark.parametrize("indent", [None, 2])
def test_large_documents_are_split_and_equal_the_whole_text(spark, tmp_root, indent):
    big, want_big = document(3000, indent)
    small, want_small = document(5, indent)
    none, _ = document(0, indent)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20011")
    try:
        rows = files(spark, tmp_root, {"big": big, "small": small, "none": none})
        splits = spark.read.text(f"{tmp_root}/client_c/Transactions_big.json", lineSep="}").rdd.getNumPartitions()
        got = loaded(rows.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert splits > 10
    assert got == {"client_c/Transactions_big.json": want_big, "client_c/Transactions_small.json": want_small}


def test_broken_documents_give_one_broken_payload(spark, tmp_root):
    from tidemark.operators.quarantine import split_payload_rejects
    good, want = document(20)
    cut = document(20)[0][:2500]
    good_rows, bad = split_payload_rejects(files(spark, tmp_root, {"good": good, "cut": cut}))
    assert [(r["_source_file"], r["reject_reason"]) for r in bad.collect()] == [("client_c/Transactions_cut.json", "raw_payload does not parse")]
    assert good_rows.count() == len(want)


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 12), st.sampled_from([None, 1]), st.lists(st.integers(0, 4000), max_size=6), st.sampled_from(["", "} ", "]"]))
def test_changes_compose_wherever_the_borders_fall(n, indent, cuts, tail):
    """The composed changes of any cutting give each split the state that a scan from the start has there."""
    text, _ = document(n, indent)
    chunks = text.split(J.SEPARATOR)
    borders = sorted({0, *(c % len(chunks) for c in cuts)})
    rows, truth, place, stack = [], {}, J.PLAIN, []
    for k, b in enumerate(borders):
        part = chunks[b:borders[k + 1] if k + 1 < len(borders) else None]
        truth[("f", b)] = (place, list(stack))
        for p in J.PLACES:
            now, closed, local = p, 0, []
            for c in part:
                found, now = J.brackets(c, now)
                for _, x in found:
                    closed += J.applied(local, x)
            rows.append({"_source_file": "f", "_split_start": b, "place": p, "after": now, "closed": closed, "open": "".join(local)})
        for c in part:
            found, place = J.brackets(c, place)
            for _, x in found:
                J.applied(stack, x)
    begins, broken = J.composed(rows)
    assert {k: v[:2] for k, v in begins.items()} == truth and not broken
