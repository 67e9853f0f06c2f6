"""Tokens, packing, quality, licenses, toxicity, edits and WARC against plain Python."""

import gzip
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from scorewell.llm import bpe_tree, edit_counts, packing, toxicity, units
from scorewell.llm import license_diagonal as lic
from scorewell.llm import quality_sketch as q
from scorewell.llm import warc_derivative as warc

BYTE, WORD = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ODD = ["", "  a  b\n\n c \t x y  ", "\n", "it's  !'s ok 's", "a b \n\t\n c　d", "x<|endoftext|> y", "x<|end", "Ab<|ENDOFTEXT|>",
       "<|startoftext|>abc\x1c d", "é́ ́x", "İstanbul ΣΑΣ ", "½²³ ×÷ ÿŸ", "A.B,C;d-e_f@g.h", "don't we'LL I'm"]


@pytest.mark.parametrize("kind,path", [("spaced", BYTE), ("word", WORD)])
def test_units_equal_the_library(kind, path, rows):
    e = units.encoder(path, kind)
    rng = random.Random(3)
    bits = ["the", "ing", "!", "'s", " ", "  ", "\n", "\t", "é", "ß", "中", "9", "X", "<|", "|>", "endoftext", "́", "Ü"]
    texts = [r[1] or "" for r in rows] + ODD + ["".join(rng.choice(bits) for _ in range(rng.randint(1, 60))) for _ in range(400)]
    got = e.encode(pa.array(texts))
    for t, a, b in zip(texts, got.row_tokens[:-1], got.row_tokens[1:]):
        assert got.ids[a:b].tolist() == e.t.encode(t, add_special_tokens=False).ids, t[:80]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_tree_equals_the_library(path):
    t = units.tokenizer(path)
    rng = random.Random(8)
    bits = ["abc", "the", "!!", "'s", "9", "é", "ß", "zx", "中", "aaaa", "<|endoftext|>", "é", "ing", "'"]
    for k in range(24):
        s = "a" * rng.randint(1, 2500) if k % 3 == 0 else "".join(rng.choice(bits) for _ in range(rng.randint(1, 700)))
        assert bpe_tree.encode(t, s, leaf=100) == t.encode(s, add_special_tokens=False).ids


def test_encode_documents_round_trip(docs, rows, none):
    t = units.tokenizer(WORD)
    got = bpe_tree.encode_documents(docs, WORD).collect()
    want = Counter()
    for r in rows:
        ids = t.encode(r[1] or "", add_special_tokens=False).ids
        back = t.decode(ids, skip_special_tokens=False)
        want[r[0], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == want
    assert all(t.decode(r.ids, skip_special_tokens=False) == r.decoded for r in got)
    assert bpe_tree.encode_documents(none, WORD).count() == 0


def test_packing_places_every_piece_once(docs, rows, none):
    t = units.tokenizer(BYTE)
    got = packing.pack_documents(docs, BYTE, capacity=256, with_ids=True)
    pieces = got.collect()
    want = Counter()
    for r in rows:
        ids = t.encode(r[1] or "", add_special_tokens=False).ids + [2]
        cut = (len(ids) - 1) % 256 + 1
        for k, a in enumerate([0, *range(cut, len(ids), 256)]):
            b = cut if k == 0 else a + 256
            want[r[0], k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter((p.doc_id, p.piece, p.start, p.length, p.ids_crc32) for p in pieces) == want
    bins = {}
    for p in pieces:
        bins.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for parts in bins.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 256
    first_fit = []
    for n in sorted((p.length for p in pieces), reverse=True):
        k = next((k for k, room in enumerate(first_fit) if room >= n), None)
        if k is None:
            first_fit.append(256)
            k = -1
        first_fit[k] -= n
    assert len(bins) <= len(first_fit)
    whole = {r.sequence_id: r for r in packing.sequences(got).collect()}
    assert set(whole) == set(bins) and all(4 * r.n_tokens == len(r.ids) for r in whole.values())
    assert packing.pack_documents(none, BYTE).count() == 0


def test_fullest_combination_is_optimal():
    rng = random.Random(6)
    for _ in range(60):
        counts = {rng.randint(1, 40): rng.randint(1, 3) for _ in range(5)}
        room = rng.randint(1, 90)
        sums = {0}
        for k, c in counts.items():
            sums = {s + k * i for s in sums for i in range(c + 1) if s + k * i <= room}
        got = packing.fullest(counts, room)
        assert sum(k * c for k, c in got.items()) == max(sums) and all(c <= counts[k] for k, c in got.items())


def counts(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    grams = Counter(zip(w, w[1:], w[2:]))
    covered = {j for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines, dup = set(), 0
    for x in (t or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += x in lines
            lines.add(x)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), dup, len(covered)


def test_quality_counts_and_verdict(docs, rows, none):
    got = q.quality_filter(docs).collect()
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == \
        Counter((r[0], *counts(r[1])) for r in rows)
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    kept = {r.doc_id for r in got if r.kept}
    assert set(range(60)) - kept <= {i for i in range(60) if counts(rows[i][1])[0] < 50}  # sound prose stays
    out = q.keep_sound(docs)
    assert out.columns == docs.columns and Counter(r.doc_id for r in out.collect()) == Counter(r.doc_id for r in got if r.kept)
    assert q.quality_filter(none).count() == 0 and q.keep_sound(none).count() == 0


def test_quality_fences_adapt(spark):
    rng = random.Random(2)
    rows = []
    for i in range(900):
        ratio = 0.3 if i < 450 else 0.0  # one source writes with symbols, the other does not
        t = " ".join(f"w{rng.randint(0, 999)}" + ("#" if rng.random() < ratio else "") for _ in range(80))
        rows.append((i, t, "en", "code" if i < 450 else "news"))
    rows.append((1000, " ".join(f"v{k}#" if k % 3 == 0 else f"v{k}" for k in range(80)), "en", "news"))
    rows.append((1001, " ".join(f"v{k}#" if k % 3 == 0 else f"v{k}" for k in range(80)), "en", "code"))
    got = {r.doc_id: r.kept for r in q.quality_filter(spark.createDataFrame(rows, "doc_id int, text string, lang string, source string")).collect()}
    assert not got[1000] and got[1001] and all(got[i] for i in range(900))


def test_quality_fences_come_from_the_tails(spark):
    """Each share rule rejects documents that stand out of their own group, none of the clean ones."""
    rng = random.Random(12)
    words = lambda n: [f"w{rng.randint(0, 10**6)}" for _ in range(n)]

    def text(symbols=0, repeated=0, lines=0):
        w = words(100)
        for k in range(symbols):
            w[k] += "#"
        w[100 - repeated:] = (w[40:43] * repeated)[:repeated]
        out = [" ".join(w[k:k + 10]) for k in range(0, 100, 10)]
        return "\n".join(out + ["menu"] * (lines + 1) if lines else out)

    rows = []
    for i in range(600):  # "forum" has tails of its own, "news" has none
        few = lambda top: int(top * rng.random() ** 3)
        rows.append((i, text(few(20), few(30), few(6)) if i % 2 else text(), "en", "forum" if i % 2 else "news"))
    odd = {"symbol_share": text(symbols=8), "repeat_share": text(repeated=24), "dup_line_share": text(lines=7)}
    for k, t in enumerate(odd.values()):
        rows += [(1000 + k, t, "en", "news"), (2000 + k, t, "en", "forum")]
    rows += [(3000 + k, t, "en", "forum") for k, t in enumerate((text(symbols=95), text(repeated=43), text(lines=60)))]
    got = {r.doc_id: r for r in q.quality_filter(spark.createDataFrame(rows, "doc_id int, text string, lang string, source string")).collect()}
    assert all(r in got[1000 + k].failed_rules for k, r in enumerate(odd))
    assert all(got[2000 + k].kept for k in range(3)) and all(got[i].kept for i in range(600))
    assert "symbol_share" in got[3000].failed_rules and "dup_line_share" in got[3002].failed_rules


def test_license_scan(spark, docs, rows, none):
    mit = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
           "documentation files (the 'Software'), to deal freely in the Software without restriction")
    extra = [(500, "Released under the MIT License. Again: UNDER the mit-license!"), (501, "some words " + mit),
             (502, "Licensed under the Apache License, Version 2.0. CC BY-NC"), (503, "under the mit licenses apache license version 20"),
             (504, None), (504, "by cc by nc"), (None, "cc by nc cc BY nc")]
    small = spark.createDataFrame(extra + [r[:2] for r in rows], "doc_id bigint, text string")
    got = lic.license_scan(small).collect()
    want = Counter()
    for i, t in extra + [r[:2] for r in rows]:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        at = [(k, label) for p, label in lic.PHRASES.items() for k in range(len(w)) if w[k:k + len(p.split())] == p.split()]
        pos = [k for k, _l in at]
        want[i, len(w), len(at), min(pos, default=None), max(pos, default=None), ",".join(sorted({x for _k, x in at}))] += 1
    assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == want
    by = {(r.doc_id, r.n_words): r for r in got}
    hit = next(r for r in got if r.doc_id == 501)
    assert hit.labels == "mit" and 0.6 <= hit.score <= 1 and hit.spans[0].votes > 10
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in got)
    assert next(r for r in got if r.doc_id == 502).labels == "apache-2,cc-by-nc" and by
    assert lic.license_scan(none).count() == 0


def test_toxicity_learns_sentences(spark, none):
    rng = random.Random(7)
    bad = ["idiot", "scumbag", "loserish", "trashy"]
    rows, labels = [], []
    for i in range(600):
        s = [" ".join(f"w{rng.randint(0, 300)}" for _ in range(rng.randint(4, 12))) for _ in range(rng.randint(2, 9))]
        y = i % 4 == 0
        if y:
            k = rng.randrange(len(s))
            s[k] = s[k] + " " + rng.choice(bad)
        rows.append((i, ". ".join(s) + "."))
        labels.append((i, 1, int(y)))
    rows += [(9000, None), (9001, ""), (None, "you idiot"), (9002, "fine words. you idiot loserish!")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    lab = spark.createDataFrame(labels + [(None, 1, 1), (3, None, None)], "doc_id bigint, quality int, toxic int")
    held = toxicity.held_out(F.col("doc_id"))
    model = toxicity.train(docs, lab, learn=~held)
    got = {r.doc_id: r for r in toxicity.score(docs, model, spans=True).collect()}
    test = [i for i in range(600) if zlib.crc32(str(i).encode()) % 4 == 2]
    right = [(got[i].score >= toxicity.THRESHOLD) == (i % 4 == 0) for i in test]
    assert sum(right) >= 0.97 * len(test)
    assert got[9000].score == got[9001].score == toxicity.EMPTY_SCORE
    text = dict(rows)
    found = [i for i in range(0, 600, 4) if any(b in text[i].encode()[x.first:x.end].decode() for x in got[i].sentences[:1] for b in bad)]
    assert len(found) >= 140 and len(got[9002].sentences) == 1  # the offending sentence is the one named
    assert toxicity.keep_clean(docs, model).columns == docs.columns
    empty = toxicity.train(docs, lab.limit(0))
    assert all(r.score < 1e-9 for r in toxicity.score(docs, empty).collect())
    assert toxicity.score(none, model).count() == 0 and held is not None


def test_toxicity_sample_passes_over_long_texts(spark):
    rows, labels = [], []
    for i in range(400):
        words = " ".join(f"w{(7 * i + k) % 60}" for k in range(12))
        rows.append((i, f"{words}. {'idiot ' if i % 2 else ''}w1 w2."))
        labels.append((i, i % 2))
    # the first documents of both labels in hash order have texts over the whole budget
    order = spark.createDataFrame(labels, "doc_id bigint, toxic int").orderBy(F.xxhash64("doc_id", F.lit(11))).collect()
    first = [next(r.doc_id for r in order if r.toxic == y) for y in (0, 1)]
    rows = [(i, "w3 w4 " * 20_000 if i in first else t) for i, t in rows]
    docs, lab = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    model = toxicity.train(docs, lab, max_words=15_000)
    got = {r.doc_id: r.score >= toxicity.THRESHOLD for r in toxicity.score(docs, model).collect()}
    assert all(got[i] == (i % 2 == 1) for i, _t in rows if i not in first)
    only_long = [(1, "w3 idiot " * 2000), (2, "w3 w5 " * 2000)]
    long = spark.createDataFrame(only_long, "doc_id bigint, text string")
    toxicity.train(long, lab.where("doc_id in (1, 2)"), max_words=100)  # the shortest stands in
    with pytest.raises(ValueError, match="no text to learn from"):
        toxicity.train(docs.where("doc_id % 2 = 0"), lab)


def test_edit_counts_equal_a_full_encoding(spark, rows, none):
    t = units.tokenizer(BYTE)
    rng = random.Random(10)
    bits = ["the", "!", "\n", " ", "\t", "é", "'s", "", "中", "<|endoftext|>", " word", "##"]
    data, want = [], []
    for i, r in enumerate(rows):
        text, edits = r[1], []
        new = text or ""
        for _ in range(rng.randint(0, 4)):
            a, d, s = rng.randint(0, len(new) + 3), rng.choice([0, 1, 5, 200]), "".join(rng.choice(bits) for _ in range(3))
            edits.append((a, d, s))
            at = min(a, len(new))
            new = new[:at] + s + new[at + d:]
        data.append((i, text, edits or None))
        want.append((len(t.encode(text or "", add_special_tokens=False).ids), len(t.encode(new, add_special_tokens=False).ids),
                     len(new), hashlib.sha256(new.encode()).hexdigest()))
    df = spark.createDataFrame(data, f"doc_id bigint, text string, edits {edit_counts.EDITS}")
    got = {r.doc_id: r for r in edit_counts.apply_edits(edit_counts.build_trees(df, BYTE, edits="edits"), BYTE).collect()}
    assert [(got[i].n_tokens_before, got[i].n_tokens, got[i].n_chars, got[i].text_sha256) for i in range(len(rows))] == want
    long = next(i for i, r in enumerate(rows) if r[1] and len(r[1]) > 20000)
    assert got[long].n_chars_encoded < 2000  # only regions are encoded again
    assert edit_counts.apply_edits(edit_counts.build_trees(none, BYTE), BYTE).count() == 0


def test_edits_of_rows_are_encoded_together(spark, monkeypatch):
    """The encoder is called per round of edits, not per edit of every row."""
    rows = [(i, "some words " * (i % 9), [(3, 2, "ab"), (5, 0, " cd"), (0, 1, None)][:i % 4]) for i in range(200)]
    df = spark.createDataFrame(rows, f"doc_id bigint, text string, edits {edit_counts.EDITS}").coalesce(1)
    trees = edit_counts.build_trees(df, BYTE, edits="edits")
    table, calls = trees.select("doc_id", "text", "edits", "unit_chars", "unit_tokens").toArrow().combine_chunks(), []

    class Local:
        schema = trees.schema
        select = lambda self, *_c: self
        mapInArrow = lambda self, run, _schema: list(run(iter(table.to_batches())))

    real = units.Encoder.encode
    monkeypatch.setattr(units.Encoder, "encode", lambda self, column: (calls.append(len(column)), real(self, column))[1])
    got = [r for b in edit_counts.apply_edits(Local(), BYTE) for r in b.to_pylist()]
    assert len(calls) == 3 and sum(calls) == sum(len(r[2]) for r in rows)
    for (i, text, edits), r in zip(rows, got):
        for a, d, new in edits:
            at = min(a, len(text))
            text = text[:at] + (new or "") + text[at + d:]
        assert (r["n_chars"], r["n_tokens"]) == (len(text), len(units.tokenizer(BYTE).encode(text, add_special_tokens=False).ids)), i


PAGE = """<!DOCTYPE html><html><head><title>T &amp; x</title><script>var a = "</p><b>";</script><style>p{}</style></head>
<body><!-- no --><p class="a>b">One&nbsp;two</p><ul><li><a href='/x'>three</a></li><li><A HREF=y.html>four</A></ul>1 < 2 &lt;b&gt;</body>"""


def test_warc_records(spark, tmp_path):
    http = "HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nX-A: b\r\n c\r\n\r\n" + PAGE
    rows = [(1, "<urn:uuid:1>", "http://h.org/d/p", "2024-01-01T00:00:00Z", http), (2, "<urn:uuid:2>", None, None, None),
            (3, None, "http://h.org", None, "no header <p>x</p>"), (4, "<urn:uuid:4>", "u", "d", "HTTP/1.1 200 OK\r\nContent-Type: image/png\r\n\r\n12"),
            (1, "<urn:uuid:1>", "http://h.org/d/p", "2024-01-01T00:00:00Z", http)]
    df = spark.createDataFrame(rows, "page_id int, record_id string, target_uri string, warc_date string, http string")
    out = warc.derivatives(df, keep=["page_id"])
    got = out.collect()
    assert Counter((r.page_id, r.warc_type) for r in got) == Counter(
        {(1, "metadata"): 2, (1, "conversion"): 2, (2, "metadata"): 1, (2, "conversion"): 1, (3, "metadata"): 1, (3, "conversion"): 1, (4, "metadata"): 1})
    text = next(r for r in got if (r.page_id, r.warc_type) == (1, "conversion"))
    meta = next(r for r in got if (r.page_id, r.warc_type) == (1, "metadata"))
    assert text.block == "T & x\nOne two\nthree\nfour\n1 < 2 <b>"
    assert text.refers_to == meta.refers_to == "<urn:uuid:1>" and text.block_digest == warc.digest(text.block.encode())
    assert meta.payload_digest == warc.digest(PAGE.encode()) and meta.payload_digest in meta.block
    assert "source-header: X-A: b c\r\n" in meta.block and "outlink: http://h.org/x\r\n" in meta.block and "outlink: http://h.org/d/y.html\r\n" in meta.block
    assert "var a" not in meta.block + text.block and text.derived_id in meta.block
    assert f"Content-Length: {len(text.block.encode())}\r\n" in text.headers
    warc.write_warc(out, str(tmp_path / "w"))
    raw = b"".join(gzip.open(p).read() for p in sorted((tmp_path / "w").glob("*.gz")))
    n = 0
    while raw:  # records parse by their lengths
        head, _, rest = raw.partition(b"\r\n\r\n")
        size = int(re.search(rb"Content-Length: (\d+)", head)[1])
        assert head.startswith(b"WARC/1.1") and rest[size:size + 4] == b"\r\n\r\n"
        raw, n = rest[size + 4:], n + 1
    assert n == len(got)
    assert warc.derivatives(df.limit(0)).count() == 0


def test_warc_source_headers_and_bytes(spark):
    """Source headers and digests come through; bytes in their own charset keep their digest."""
    body = "<p>Grüße</p>".encode("latin-1")
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=ISO-8859-1\r\n\r\n" + body
    given = {"WARC-Payload-Digest": "sha256:abc", "WARC-Block-Digest": "md5:def", "WARC-IP-Address": "10.0.0.1", "WARC-Null": None}
    rows = [("<urn:uuid:1>", "http://h.org/", "d", bytearray(http), given), ("<urn:uuid:2>", "u", "d", bytearray(http), None),
            ("<urn:uuid:3>", "u", "d", None, {}), ("<urn:uuid:4>", "u", "d", bytearray(b"HTTP/1.1 200 OK\r\nContent-Type: text/plain; charset=nope\r\n\r\n\xff"), {})]
    df = spark.createDataFrame(rows, "record_id string, target_uri string, warc_date string, http binary, warc map<string,string>").withColumn("_http", F.lit(1))
    got = {(r.refers_to[-2], r.warc_type): r for r in warc.derivatives(df, keep=["_http"], headers="warc").collect()}
    meta = got["1", "metadata"]
    assert meta.payload_digest == "sha256:abc" and "source-payload-digest: sha256:abc\r\n" in meta.block and meta._http == 1
    assert "source-block-digest: md5:def\r\n" in meta.block and "source-warc-header: WARC-IP-Address: 10.0.0.1\r\n" in meta.block and "WARC-Null" not in meta.block
    assert got["1", "conversion"].block == "Grüße" and got["2", "metadata"].payload_digest == warc.digest(body)
    assert got["3", "metadata"].payload_digest == warc.digest(b"") and got["4", "conversion"].block == "\ufffd"


def test_many_notices_in_one_text(spark):
    """Each of 400 notices is a span; the text is read once, not once a span."""
    import time
    notice = lic.NOTICES["mit"][0]
    text = " ".join(f"filler{k} words here between {notice}" for k in range(400))
    t = time.time()
    got = lic.license_scan(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert len(got.spans) == 400 and got.labels == "mit" and got.score == 1.0 and time.time() - t < 60


def test_every_text_is_joined_up_the_tree(monkeypatch):
    import random
    rng = random.Random(3)
    words = ["the", "don't", "café", "Über", "été", "naive,", "x" * 90, "<|endoftext|>", "漢字" * 20, "12345", "\n\n", "a.b.c", " ", "<|"]
    texts = ["", "one", None] + [" ".join(rng.choices(words, k=n)) for n in (3, 40, 200, 700)] + ["y" * 5000, "漢" * 900, " " * 3000]
    joined = []
    spliced = bpe_tree._spliced
    monkeypatch.setattr(bpe_tree, "_spliced", lambda *a: joined.append(1) or spliced(*a))
    for path, kind in ((WORD, "word"), (BYTE, "spaced")):
        enc = units.Encoder(path, kind)
        for leaf in (64, 300, bpe_tree.LEAF):
            joined.clear()
            ids, at = bpe_tree.encode_column(enc, pa.array(texts), leaf=leaf, window=16)
            assert len(joined) >= sum(max(0, -(-len((x or "").encode()) // leaf) - 1) for x in texts)
            for x, a, b in zip(texts, at, at[1:]):
                assert ids[a:b].tolist() == enc.t.encode(x or "", add_special_tokens=False).ids
