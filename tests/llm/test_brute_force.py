"""Operators that SQL cannot express, against plain versions over whole small tables."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import components, decontamination, html_text, licenses, multi_index, pieces, ppm, quality, queries, simhash, suffix_dedup
from tidemark.llm.common import table
from tidemark.llm.suffix import suffix_order

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return [(r["doc_id"], r["text"] or "") for r in table(spark, SF, "documents").orderBy("doc_id").collect()]


def rows(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


# ------------------------------------------------------------------------- op1

def plain_fingerprint(text: str) -> int:
    words = re.findall(rb"[^\x20\x09-\x0D]+", text.encode().lower())
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_equals_brute_force(spark, texts):
    fps = [plain_fingerprint(t) for _, t in texts]
    label = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(fps):
            low = min(label[j] for j, b in enumerate(fps) if (a ^ b).bit_count() <= 4)
            changed |= low != label[i]
            label[i] = low
    found = rows(queries.op1_simhash(spark, SF))
    for k, (i, _) in enumerate(texts):
        assert found[i]["fingerprint"] == f"{fps[k]:016x}" and found[i]["component_id"] == texts[label[k]][0]


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=4))
def test_golay_keys_meet_within_four_bits(fp, bits):
    other = fp
    for b in bits:
        other ^= 1 << b
    probe = simhash.keys(np.array([fp], np.uint64).view(np.int64), "probe")[1]
    build = simhash.keys(np.array([other], np.uint64).view(np.int64), "build")[1]
    assert set(probe.tolist()) & set(build.tolist())


def test_golay_code_is_perfect():
    _, _, errors = simhash.tables()
    assert len(set(errors.tolist())) == 2048 and max(int(e).bit_count() for e in errors) == 3


def test_dense_group_and_stray_components(spark):
    rng = random.Random(5)
    base = rng.getrandbits(64)
    dense = {base ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(20)}
    chain = [rng.getrandbits(64)]
    for i in range(30):  # each four bits from the one before
        chain.append(chain[-1] ^ 0b1111 << (4 * (i % 16)))
    strays = {rng.getrandbits(64) for _ in range(50)}
    fps = sorted(dense | set(chain) | strays)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x, x) for x in signed], "fp long, comp long")
    links = simhash.star_links(df).union(simhash.cross_links(df))
    found = {r["id"]: r["root"] for r in components.components(links).collect()}
    label = {x: found.get(s, s) for x, s in zip(fps, signed, strict=True)}
    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if (a ^ b).bit_count() <= 4:
                assert label[a] == label[b]
    assert len({label[x] for x in dense}) == 1 and len({label[x] for x in strays}) >= 49


# ------------------------------------------------------------------------- op2

def plain_model(train: list[bytes], order: int = ppm.ORDER):
    counts: dict = collections.defaultdict(collections.Counter)
    for text in train:
        s = [256] * order + list(text) + [256]
        for i in range(order, len(s)):
            for k in range(order + 1):
                counts[tuple(s[i - k:i])][s[i]] += 1
    return counts


def plain_score(counts, text: bytes, order: int = ppm.ORDER) -> float:
    s, total = [256] * order + list(text) + [256], 0.0
    for i in range(order, len(s)):
        excluded: set = set()
        for k in range(order, -2, -1):
            if k < 0:
                total -= math.log10(257 - len(excluded))
                break
            seen = {x: n for x, n in counts.get(tuple(s[i - k:i]), {}).items() if x not in excluded}
            if not seen:
                continue
            t, d = sum(seen.values()), len(seen)
            if s[i] in seen:
                total += math.log10(seen[s[i]] / (t + d))
                break
            total += math.log10(d / (t + d))
            excluded |= set(seen)
    return total


def test_ppm_equals_plain_trie(spark):
    rng = random.Random(1)
    data = [(i, "".join(rng.choice("abcd e") for _ in range(rng.randint(0, 80))) + ("é" if i % 5 == 0 else "")) for i in range(60)]
    held = {i for i, _ in data if zlib.crc32(str(i).encode()) % 7 == 2}
    train = [t.encode() for i, t in data if i not in held]
    counts = plain_model(train)
    words = collections.Counter(w for t in train for w in [*t.lower().split(), None])
    n, v = sum(words.values()), len(words)
    docs = spark.createDataFrame(data, "doc_id long, text string")
    flagged = docs.selectExpr("doc_id", "text", "crc32(cast(cast(doc_id as string) as binary)) % 7 = 2 AS held_out")
    # one pass over the whole model and all words; key ranges and joined rare words
    for found in (rows(ppm.lm_scores(docs)), rows(ppm.scored(flagged, flagged.where("NOT held_out"), max_grams=600, max_words=10))):
        assert len(found) == 60
        for i, t in data:
            tokens = [*t.encode().lower().split(), None]
            r = found[i]
            assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (i in held, len(tokens), sum(words[w] > 0 for w in tokens), n)
            assert abs(r["base_score"] - sum(math.log10((words[w] + 1) / (n + v + 1)) for w in tokens)) < 1e-6
            assert abs(r["score"] - plain_score(counts, t.encode())) < 1e-3


def test_ppm_is_a_distribution():
    keys = np.concatenate([k for _, k in ppm.gram_keys([b"abracadabra", b"banana bandana", b""])])
    grams = np.unique(keys, return_counts=True)
    shared = [ppm.merge_counts(ppm.suffix_keys(grams[0], ppm.ORDER, k), grams[1].astype(float)) for k in (0, 1)]
    model = ppm.Model(grams[0], grams[1], shared)
    for context in (b"abra", b"zzzz", b"nana", b"zban"):
        head = 0
        for back, c in enumerate(reversed(context), start=1):
            head |= c << (9 * (ppm.ORDER + 1 - back))
        assert abs((10 ** model.log10(head | np.arange(257))).sum() - 1) < 1e-4


# ------------------------------------------------------------------------- op3

def plain_notices(words: list[str]) -> dict[str, float]:
    """Labels of notices with their best share, from all places of all pairs."""
    out: dict[str, float] = {}
    at = collections.defaultdict(list)
    for k, pair in enumerate(zip(words, words[1:])):
        at[pair].append(k)
    for label, text in licenses.NOTICES:
        pairs = list(zip(text.split(), text.split()[1:]))
        hits = [(i, k) for i, pair in enumerate(pairs) for k in at.get(pair, ())]
        for d in {k - i for i, k in hits}:
            first: dict[int, int] = {}
            for i, k in hits:
                if d <= k - i <= d + licenses.DRIFT:
                    first[i] = min(k, first.get(i, k))
            ks = [first[i] for i in sorted(first)]
            n = sum(j == 0 or k > ks[j - 1] for j, k in enumerate(ks))
            if n >= licenses.SHARE * len(pairs):
                out[label] = max(out.get(label, 0.0), n / len(pairs))
    return out


def test_scrambled_notices_have_no_label(spark):
    data = []
    for i, (label, text) in enumerate(licenses.NOTICES):
        words = text.split()
        pairs = [" ".join(words[k:k + 2]) for k in range(len(words) - 1)]
        rng = random.Random(i)
        mixed = rng.sample(pairs, len(pairs))
        data += [(3 * i, " ".join(pairs[::-1])), (3 * i + 1, " filler ".join(mixed)), (3 * i + 2, f"some words {text} more words")]
    found = rows(licenses.scanned(spark.createDataFrame(data, "doc_id long, text string")))
    for i, text in data:
        assert (found[i]["score"] == 1.0) if i % 3 == 2 else set(found[i]["labels"].split(",")) <= set(found[i]["base_labels"].split(",")), text


def test_licenses_equal_brute_force(spark, texts):
    found = rows(queries.op3_licenses(spark, SF))
    for i, t in texts:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.encode().lower().decode())
        places = [(k, label) for label, phrase in licenses.PHRASES for k in range(len(words))
                  if words[k:k + len(phrase.split())] == phrase.split()]
        r = found[i]
        assert (r["n_words"], r["n_base"]) == (len(words), len(places))
        assert r["first_word"] == min((k for k, _ in places), default=None) and r["last_word"] == max((k for k, _ in places), default=None)
        notices = plain_notices(words)
        assert r["base_labels"] == ",".join(sorted({x for _, x in places}))
        assert r["labels"] == ",".join(sorted({x for _, x in places} | set(notices)))
        assert r["score"] == (1.0 if places else max(notices.values(), default=0.0))


def test_license_notice_with_changed_words(spark):
    gpl = licenses.NOTICES[0][1].split()
    changed = " ".join(gpl[:12] + ["really"] + gpl[12:30] + gpl[31:])
    docs = spark.createDataFrame([(1, "x y " + changed), (2, " ".join(gpl[:9])), (3, "GNU General Public License " * 3)], "doc_id long, text string")
    found = rows(licenses.scanned(docs))
    assert found[1]["labels"] == "gpl" and 0.7 <= found[1]["score"] <= 1 and found[2]["labels"] == ""
    assert (found[3]["n_base"], found[3]["first_word"], found[3]["last_word"]) == (3, 0, 8)


# -------------------------------------------------------------------- op4, op5

def test_quality_and_language_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    scored = queries.op4_quality(spark, sf).join(table(spark, sf, "labels"), "doc_id")
    assert scored.where("keep = (quality = 1)").count() >= 0.98 * scored.count()
    pred = queries.op5_language(spark, sf).join(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id").where("held_out")
    assert pred.where("lang = lang_pred").count() >= 0.97 * pred.count() > 0


def test_quality_equals_plain_co_training(spark):
    """All rows without a label take part: same model as with every feature in memory, few rounds' rows at a time."""
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    label = {r["doc_id"]: r["quality"] for r in labels.collect()}
    rest = [(r["doc_id"], quality.text_view((r["text"] or "").encode()), quality.page_view(r["source"], r["lang"], r["n_chars"]))
            for r in docs.collect() if r["doc_id"] not in label]
    rows_ = quality.featured(quality.plain(docs), labels).cache()
    assert rows_.where("y IS NULL").count() == len(rest) > 0 and rows_.where("y IS NOT NULL").count() + len(rest) == docs.count()
    order = {r["doc_id"]: (r["h"], r["doc_id"]) for r in rows_.select("h", "doc_id").collect()}

    def plain_surest(w, platt, sure, each, taken):
        out = []
        for v in (0, 1):
            p = [float(quality.sigmoid(quality.odds_of(v, w, platt, x[1 + v][None, :]))[0]) for x in rest]
            for c in (0, 1):
                side = [round(q if c else 1 - q, 9) for q in p]
                best = sorted((-s, order[x[0]], i) for i, (s, x) in enumerate(zip(side, rest, strict=True)) if s >= sure and x[0] not in taken)
                out += [(v, c, rest[i][0], *rest[i][1:]) for *_, i in best[:each]]
        return out

    a, b, y = quality.labelled(rows_, 6000)
    plain = quality.co_train(a, b, y, plain_surest, sure=0.8, each=3)
    spread = quality.co_train(a, b, y, lambda *state: quality.surest(rows_, *state), sure=0.8, each=3)
    for one, two in zip([*plain[0], *plain[1], plain[2]], [*spread[0], *spread[1], spread[2]], strict=True):
        assert np.allclose(one, two, rtol=1e-6, atol=1e-8)


def test_quality_sample_of_one_repeated_id(spark):
    docs = spark.createDataFrame([(1, f"text {i} of one id", "en", "s", 20) for i in range(500)], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert len(quality.labelled(quality.featured(quality.plain(docs), labels), 40)[2]) == 20


# ------------------------------------------------------------------------- op6

def test_pieces_equal_the_library_without_dropout(texts):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=pieces.model_file())
    coder = pieces.encoder(pieces.model_file())
    sample = [t for _, t in texts] + ["a  b\n\tc x é 漢  ﬁ  ", " lead\n\n  two", "     many", ""]
    assert [x.tolist() for x in coder.encode(sample)] == [sp.encode(t) for t in sample]


def plain_dropout(unit: str, vocab, dropout: float, key: int) -> list[int]:
    """One unit by an agenda of candidates, one at a time."""
    import heapq

    name = np.uint64(xxhash.xxh3_64_intdigest(unit.encode(), key))
    symbols = [(vocab.symbol(c), i, 1) for i, c in enumerate(unit)]
    while True:
        agenda = []
        for i in range(len(symbols) - 1):
            (a, start, n), (b, _, m) = symbols[i], symbols[i + 1]
            piece = int(vocab.merge_of(np.array([a]), np.array([b]))[0])
            what = np.array([start << 24 ^ n << 12 ^ m], np.uint64)
            skipped = int(pieces.mixed(name ^ pieces.mixed(what))[0] >> np.uint64(11)) < dropout * (1 << 53)
            if piece >= 0 and not skipped:
                heapq.heappush(agenda, (int(vocab.rank[piece]), i, piece))
        if not agenda:
            return [s for s, _, _ in symbols]
        _, i, piece = agenda[0]
        symbols[i:i + 2] = [(piece, symbols[i][1], symbols[i][2] + symbols[i + 1][2])]


@settings(max_examples=60, deadline=None)
@given(st.text(st.sampled_from("theraniogs ▁\né"), max_size=40), st.sampled_from([0.0, 0.1, 0.5, 1.0]))
def test_dropout_equals_agenda_and_decodes(text, dropout):
    coder = pieces.encoder(pieces.model_file(), dropout, 7, 2)
    ids = coder.encode([text])[0].tolist()
    assert coder.vocab.decode(ids) == text.encode()
    if text:
        key = 7 * 1_000_003 + coder.variant(text)
        want = []
        for unit in pieces._UNITS.findall(" " + text):
            for s in plain_dropout(unit, coder.vocab, dropout, key):
                want += [s] if s < coder.vocab.size else [int(coder.vocab.byte[x]) for x in chr(s - coder.vocab.size).encode()]
        assert ids == want


def test_long_units_by_heap_equal_the_steps(monkeypatch, texts):
    coder = pieces.encoder(pieces.model_file(), 0.2, 3, 1)
    units = ["internationalisation" * 12, "xyxyyx" * 40, "né" * 70] + [u for _, t in texts[:20] for u in pieces._UNITS.findall(" " + t)]
    heap = [pieces.merge_long(u, coder.vocab, 0.2, 9) for u in units]
    monkeypatch.setattr(pieces, "LONG_UNIT", 10**9)
    flat, count = pieces.merge_units(units, coder.vocab, 0.2, 9)
    got = np.split(flat, np.cumsum(count)[:-1])
    for h, g in zip(heap, got, strict=True):
        plain = [b for x in h for b in ([x] if x < coder.vocab.size else [int(coder.vocab.byte[c]) for c in chr(x - coder.vocab.size).encode()])]
        assert plain == g.tolist()


def test_dropout_varies_with_the_seed():
    model = pieces.model_file()
    text = "segmentation of internationalisation varies"
    assert len({tuple(pieces.encoder(model, 0.3, s, 1).encode([text])[0].tolist()) for s in range(5)}) > 1


def test_dropout_draws_for_every_text_and_place(spark):
    model = pieces.model_file()
    docs = spark.createDataFrame([(i, f"{i} " + "the segmentation " * 20 + "é" * 200) for i in range(30)], "doc_id long, text string")
    vocab = pieces.encoder(model).vocab
    seen, within = set(), 0
    for r in pieces.encoded(docs, model, 0.1, 42).collect():
        assert vocab.decode(r["ids"]).decode() == r["text"]
        cuts = " ".join(map(str, r["ids"])).split(f" {vocab.ids[' the']} ")
        within = max(within, len(set(cuts)))
        seen.update(cuts)
    assert within > 2 and len(seen) > 10


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("theraniogs ▁\né"), max_size=40), max_size=4), st.sampled_from([0.1, 0.5, 1.0]))
def test_trees_of_agendas_equal_the_agenda(texts, dropout):
    coder = pieces.encoder(pieces.model_file(), dropout, 7, 0)
    for text, ids in zip(texts * 2, coder.encode(texts) + coder.encode(texts), strict=True):
        want = []
        with pytest.MonkeyPatch.context() as patch:
            for place, unit in enumerate(pieces._UNITS.findall(" " + text) if text else []):
                key = np.array([xxhash.xxh3_64_intdigest(text.encode(), 7)], np.uint64) ^ pieces.mixed(np.array([place + 1], np.uint64))
                patch.setattr(xxhash, "xxh3_64_intdigest", lambda *_, k=int(pieces.mixed(key)[0]): k)
                for s in plain_dropout(unit, coder.vocab, dropout, 0):
                    want += [s] if s < coder.vocab.size else [int(coder.vocab.byte[x]) for x in chr(s - coder.vocab.size).encode()]
                patch.undo()
        assert ids.tolist() == want


# ------------------------------------------------------------------------- op7

def test_leaks_equal_substring_search(spark, texts):
    items = [(r["item_id"], " ".join(r["text"].split())) for r in table(spark, SF, "benchmark").collect()]
    want = {(i, k) for i, t in texts for k, x in items if x in " ".join(t.split())}
    assert {(r["doc_id"], r["item_id"]) for r in queries.op7_decontamination(spark, SF).collect()} == want


def test_renamed_questions_need_consistent_slots(spark):
    item = "yesterday Alice gave Bob 12 apples and then Bob gave Alice 30 pears before they walked 5 km to the market together."
    same = item.replace("Alice", "Carol").replace("Bob", "Dave").replace("12", "77").replace("30", "41").replace("5 km", "9 miles")
    mixed = item.replace("gave Bob 12", "gave Carol 12").replace("Bob gave Alice", "Dave gave Erin")
    docs = spark.createDataFrame([(1, "So " + same), (2, "So " + mixed), (3, "So " + item.upper()), (4, "nothing of this kind is said here at all")], "doc_id long, text string")
    found = rows(decontamination.leaks(docs, spark.createDataFrame([(9, item)], "item_id long, text string")))
    assert found[1]["exact"] is False and found[3]["exact"] is True and 4 not in found and 2 not in found
    joined = rows(decontamination.leaks(docs, spark.createDataFrame([(9, item)], "item_id long, text string"), max_known=0))
    assert joined == found


def test_leaks_with_changed_numbers_and_few_words(spark):
    item = "a farmer with 5 cows and 12 hens sells 5 eggs a day at 30 cents each and buys back the feed he needs every second week"
    items = spark.createDataFrame([(1, item), (2, "12 + 30 = 42"), (3, "Quite short indeed"), (4, "1 2 3 4 5 6 7 8 9")], "item_id long, text string")
    said = ["So " + item.replace("5 cows", "6 cows"), "So " + item.replace("12", "7").replace("30", "7"), "it says 12 + 30 = 42 there", "12 and 31 or 42",
            "that was quite short indeed, I think", "0 1 2 3 4 5 6 7 8 9 10", "9 8 7 6 5 4 3 2 1"]
    docs = spark.createDataFrame(list(enumerate(said)), "doc_id long, text string")
    want = [(0, 1, False), (1, 1, False), (2, 2, True), (4, 3, True), (5, 4, True)]
    for most in (decontamination.MAX_KNOWN, 0):
        assert sorted((r["doc_id"], r["item_id"], r["exact"]) for r in decontamination.leaks(docs, items, most).collect()) == want


# ------------------------------------------------------------------------- op8

PAGE = """<html><head><title>t</title><style>p{}</style></head><body><header><a href=x>Home</a></header><nav><ul><li>Menu</ul></nav>
<div class="cookie-notice">We use cookies</div><main><h1>Title &amp;  more</h1><p>First <b>bold</b> para<p>Second&nbsp;one <a href=y>link</a>.
<div class="ad">Buy</div><form><p>Mail</p><input></form><p>x<script>var t="</p>";</script></p><section id="comments"><p>Nice!</p></section>
</main><aside>Side</aside><footer>Foot</footer></body></html>"""


def test_html_of_made_pages():
    assert html_text.main_text(PAGE) == "Title & more\nFirst bold para\nSecond one link.\nx"
    bare = PAGE.replace("<main>", "<div>").replace("</main>", "</div>")
    assert html_text.main_text(bare) == "Title & more\nFirst bold para\nSecond one link.\nx"
    assert html_text.main_text("a < b & c") == "a < b & c"


def test_html_equals_article_blocks(spark):
    import html

    pages = {r["page_id"]: r["html"] for r in table(spark, SF, "pages").collect()}
    for i, r in rows(queries.op8_html(spark, SF), "page_id").items():
        article = re.split(r"</article>|<footer", pages[i].split("<article>")[1])[0]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert r["text"] == "\n".join(filter(None, blocks)) and r["n_chars"] == len(r["text"])


def test_surge_and_dive():
    keep = html_text.between_surges(np.array([5.0, 0, 0, 0, 0, 90, 3, 120, 0, 0, 0, 4]), 3, 80.0)
    assert np.flatnonzero(keep).tolist() == [5, 6, 7]


def test_html_text_beside_article_tags_surges():
    body = ["A paragraph of the text that the page is about, " * 3, "Another long paragraph of the text, " * 3]
    teasers = "".join(f"<article><h3><a href=/{i}>Teaser {i}</a></h3></article>" for i in range(4))
    page = f"<body><div>Tagline</div><div id=content><p>{body[0]}</p><p>{body[1]}</p></div>{teasers}<nav>Menu</nav></body>"
    found = html_text.main_text(page).split("\n")
    assert [x.strip() for x in body] == found[-2:] and not any("Teaser" in x for x in found)
    links = "".join(f"<li><a href=/{i}>Link {i}</a></li>" for i in range(9))
    assert html_text.main_text(f"<main><ul>{links}</ul><p>Short.</p></main><p>Beside.</p>") == "Short."
    assert html_text.main_text("<main><p><a name=top>Short.</p><p>End.</p></main>") == "Short.\nEnd."


def test_html_closing_part_after_an_interruption():
    long, short = "The article goes on for a while. " * 6, "It closes with one short line of sixty characters."
    notices = "".join(f"<div class=ad><p>Buy {i}</p></div>" for i in range(4))
    links = "".join(f"<li><a href=/{i}>Source {i}</a></li>" for i in range(4))
    sources = "\n".join(f"Source {i}" for i in range(4))
    for a, b in (("<div id=c>", "</div>"), ("", ""), ("<article>", "</article>")):
        assert html_text.main_text(f"<body>{a}<p>{long}</p>{notices}<p>{short}</p>{b}</body>") == f"{long.strip()}\n{short}"
        assert html_text.main_text(f"<body>{a}<p>{long}</p><ul>{links}</ul><p>{short}</p>{b}</body>") == f"{long.strip()}\n{sources}\n{short}"
        assert html_text.main_text(f"<body>{a}<h1><a href=/>Title</a></h1><p>{long}</p><ul>{links}</ul>{b}</body>") == f"Title\n{long.strip()}"


# ------------------------------------------------------------------------- op9

def test_index_recall(spark):
    vectors = {r["vec_id"]: r["embedding"] for r in table(spark, "/root/testdata/sf0.1", "embeddings").collect()}
    ids = np.array(sorted(vectors))
    x = np.array([vectors[i] for i in ids], float)
    found = collections.defaultdict(list)
    for r in queries.op9_multi_index(spark, "/root/testdata/sf0.1").orderBy("rank").collect():
        found[r["query_id"]].append((r["vec_id"], r["score"]))
    hits = total = 0
    for k in np.flatnonzero(ids % 20 == 0):
        s = x @ x[k]
        s[k] = -np.inf
        best = set(ids[np.lexsort((ids, -s))[:20]].tolist())
        got = found[int(ids[k])]
        assert len(got) == 20 and all(abs(v - s[np.searchsorted(ids, i)]) < 1e-9 for i, v in got)
        hits, total = hits + len(best & {i for i, _ in got}), total + 20
    assert hits / total >= 0.9


def test_index_with_many_blocks_and_chunks(spark, monkeypatch, tmp_path):
    """The same rows however queries and entries are cut; entries without visitors are not copied."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    draw = np.random.default_rng(9)
    x = np.repeat(draw.normal(size=(40, 16)), 100, axis=0) + 0.1 * draw.normal(size=(4000, 16))
    pq.write_table(pa.table({"vec_id": np.arange(len(x)), "embedding": list(x)}), str(tmp_path / "e.parquet"))
    vectors = spark.read.parquet(str(tmp_path / "e.parquet"))
    want = sorted(tuple(r) for r in multi_index.search(vectors, top=5, first=50).collect())
    copies = []
    plain = multi_index.meetings

    def counted(queries, index, books, *rest):
        left, right = plain(queries, index, books, *rest)
        copies.append((left.select("i", "query_id").distinct().count(), right.count(), books.k))
        return left, right
    monkeypatch.setattr(multi_index, "meetings", counted)
    monkeypatch.setattr(multi_index, "BLOCK_QUERIES", 16)
    monkeypatch.setattr(multi_index, "CHUNK_ENTRIES", 64)
    got = sorted(tuple(r) for r in multi_index.search(vectors, top=5, first=50).collect())
    assert [r[:3] for r in got] == [r[:3] for r in want] and np.allclose([r[3] for r in got], [r[3] for r in want])
    per_centroid = len(x)  # an entry meets ceil(visitors / 16) blocks of its own centroid
    assert all(n <= (visits / 16 + k) * per_centroid / k * 3 for visits, n, k in copies)


def test_index_margin_and_recall_beyond_the_sample(spark, monkeypatch, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    monkeypatch.setattr(multi_index, "FIT_ROWS", 400)
    draw = np.random.default_rng(5)
    x = np.repeat(draw.normal(size=(100, 32)), 200, axis=0) + 0.5 * draw.normal(size=(20_000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    pq.write_table(pa.table({"vec_id": np.arange(len(x)), "embedding": list(x)}), str(tmp_path / "e.parquet"))
    vectors = spark.read.parquet(str(tmp_path / "e.parquet"))
    found = collections.defaultdict(set)
    for r in multi_index.search(vectors, modulus=200).collect():
        found[r["query_id"]].add(r["vec_id"])
    score = x[::200] @ x.T
    score[np.arange(100), np.arange(0, len(x), 200)] = -np.inf
    want = np.argsort(-score, axis=1)[:, :20]
    assert sum(len(found[200 * n] & set(w.tolist())) for n, w in enumerate(want)) >= 0.97 * want.size
    books, _ = multi_index.fit(vectors.select("vec_id", F.col("embedding").alias("v")), 200, 20, 0.97)
    i, j = books.cells(x)
    s, t = books.sums(x[::200])
    at = np.arange(100)[:, None]
    assert books.margin == pytest.approx(np.quantile(score[at, want] - s[at, i[want]] - t[at, j[want]], 0.97))


# ------------------------------------------------------------------------ op10

@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=60))
def test_suffix_order(symbols):
    s = [*symbols, 0]
    assert suffix_order(s) == sorted(range(len(s)), key=lambda i: s[i:])


def plain_repeats(texts: list[bytes], n: int = suffix_dedup.LENGTH) -> list[np.ndarray]:
    seen = collections.Counter(t[k:k + n] for t in texts for k in range(len(t) - n + 1))
    out = []
    for t in texts:
        covered = np.zeros(len(t), bool)
        for k in range(len(t) - n + 1):
            if seen[t[k:k + n]] > 1:
                covered[k:k + n] = True
        out.append(covered)
    return out


def repeats_case(spark, texts, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "f long, text string").selectExpr("f", "0L AS r", "cast(text as binary) AS text")
    spans = {r["f"]: suffix_dedup.merged(r["spans"]) for r in suffix_dedup.repeated_spans(docs, **options).collect()}
    for i, covered in enumerate(plain_repeats([t.encode() for t in texts])):
        want = np.zeros(len(covered), bool)
        for a, b in spans.get(i, []):
            want[a:b] = True
        assert (want == covered).all(), i


def test_repeats_of_made_texts(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdé") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    base = [" ".join(rng.choice(words) for _ in range(120)) for _ in range(12)]
    texts = base + [base[0], base[1][:300] + "X" + base[1][300:], "Y" * 700, "ab" * 400, base[2] + base[2], base[3][50:320], base[4][10:209], ""]
    texts += [f"{i} {' '.join(rng.choice(words) for _ in range(30))} {base[5][100:260]} {' '.join(rng.choice(words) for _ in range(30))}" for i in range(40)]
    texts += [base[6][:250 + i] + "Z" * (i % 3) + base[6][250 + i:] for i in range(20)]
    repeats_case(spark, texts)
    repeats_case(spark, texts, max_regions=3)


def test_suffix_dedup_equals_brute_force(spark, texts):
    found = rows(queries.op10_suffix_dedup(spark, SF))
    data = [t.encode() for _, t in texts]
    for (i, _), t, covered in zip(texts, data, plain_repeats(data), strict=True):
        kept = np.frombuffer(t, np.uint8)[~covered].tobytes()
        spans = int((np.diff(np.concatenate(([0], covered.astype(int)))) == 1).sum())
        r = found[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (len(t), int(covered.sum()), spans, hashlib.sha256(kept).hexdigest())


# -------------------------------------------------------------------- pipeline

def test_pipeline_equals_plain_stages(spark, texts):
    found = rows(corpus_pipeline.run(spark, SF))
    kept = {r["doc_id"] for r in queries.op4_quality(spark, SF).where("keep").collect()}
    left = [(i, t) for i, t in texts if i in kept]
    fps = [plain_fingerprint(t) for _, t in left]
    label = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for k, a in enumerate(fps):
            low = min(label[j] for j, b in enumerate(fps) if (a ^ b).bit_count() <= 4)
            changed |= low != label[k]
            label[k] = low
    left = [x for k, x in enumerate(left) if label[k] == k]
    data = [t.encode() for _, t in left]
    cut = [(i, np.frombuffer(t, np.uint8)[~c].tobytes().decode("utf-8", "ignore")) for (i, _), t, c in zip(left, data, plain_repeats(data), strict=True)]
    cut = [(i, t) for (i, t), (_, before) in zip(cut, left, strict=True) if t or not before]
    items = [" ".join(r["text"].split()) for r in table(spark, SF, "benchmark").collect()]
    whole = {i: t for i, t in cut if not any(x in " ".join(t.split()) for x in items)}
    assert {i: r["text"] for i, r in found.items()} == whole
    vocab = pieces.encoder(pieces.model_file(), 0.1, 42, 2).vocab
    assert all(vocab.decode(r["ids"]).decode() == r["text"] for r in found.values())
