"""License scans by diagonal voting.

Rolling hashes of ``K`` consecutive words of every whole text are joined by
Spark to the positions of the same hashes in license templates.  Each match
votes for its diagonal (document position minus template position); votes are
counted per (document, template, diagonal), neighbouring diagonals (an inserted
or dropped word shifts the diagonal) are merged to one span, and the span's
words are compared with the template's before a label is given.

The template side is a fixed list (a few hundred words), so its hash table is
broadcast by that bound; the tasks use it to keep only grams that can join.

Defined results: null or empty text has no words, no label and score 0;
repeated rows are scanned separately (an internal row number, fixed by the
staged scan, is the key); null doc_id passes through; an empty table gives an
empty result; only the named columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorewell.llm.common import staged
from scorewell.llm.textbytes import ALNUM_WORD, Words, pieces

K = 4
NEIGHBOUR = 3        # diagonals this close belong to one span
MIN_VERIFIED = 0.6   # share of the template's words found in order

#: base phrases: words -> label
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: fixed values: opening notices of public licenses, label -> notices
NOTICES = {
    "mit": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction"],
    "apache-2": ["Licensed under the Apache License, Version 2.0",
                 "you may not use this file except in compliance with the License. You may obtain a copy of the License at"],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"],
    "gpl": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation",
            "licensed under the GNU General Public License"],
    "lgpl": ["under the terms of the GNU Lesser General Public License"],
    "mpl-2": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"],
    "cc-by": ["This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "cc-by-nc": ["This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
                 "licensed under CC BY-NC 4.0"],
    "isc": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"],
    "all-rights-reserved": ["All rights reserved. No part of this work may be reproduced"],
}

_TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: str) -> list[str]:
    """Words of a text; only A-Z are lower-cased."""
    return _TOKEN.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text))


def templates() -> list[tuple[int, str, list[str]]]:
    return [(i, label, words_of(t)) for i, (label, t) in enumerate((k, t) for k, ts in NOTICES.items() for t in ts)]


def _gram_hashes(words: list[str], k: int) -> np.ndarray:
    w = Words(pa.array([" ".join(words)]), ALNUM_WORD)
    return w.grams(w.hashes(), k)[0]


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: word count, places of the base phrases, the grams
    that occur in a template, and the text where there are any."""
    phrases = [(p.split(), label) for p, label in PHRASES.items()]
    phrase_hash = [(len(p), _gram_hashes(p, len(p))[0], " ".join(p).encode(), label) for p, label in phrases]
    known = np.unique(np.concatenate([_gram_hashes(t, K) for _, _, t in templates() if len(t) >= K]))
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def places(w: Words, h: np.ndarray, n: int, want: np.uint64, phrase: bytes) -> np.ndarray:
        g, at = w.grams(h, n)
        hit = at[g == want]
        # compare the bytes of each word; separators between them may be any
        parts = phrase.split()
        same = [all(bytes(w.data[w.start[i + j]:w.end[i + j]]) == parts[j] for j in range(n)) for i in hit]
        return hit[np.array(same, bool)] if len(hit) else hit

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in pieces(batch):
                w = Words(b.column(1), ALNUM_WORD, lower=True)
                h = w.hashes()
                n = b.num_rows
                count = np.zeros(n, np.int64)
                first = np.full(n, np.iinfo(np.int64).max)
                last = np.full(n, -1)
                labels: list[set[str]] = [set() for _ in range(n)]
                for size, want, phrase, label in phrase_hash:
                    hit = places(w, h, size, want, phrase)
                    row = w.row[hit]
                    pos = hit - w.first[row]
                    np.add.at(count, row, 1)
                    np.minimum.at(first, row, pos)
                    np.maximum.at(last, row, pos)
                    for r in np.unique(row):
                        labels[r].add(label)
                g, at = w.grams(h, K)
                i = np.minimum(np.searchsorted(known, g), len(known) - 1)
                ok = known[i] == g
                row, pos = w.row[at[ok]], at[ok] - w.first[w.row[at[ok]]]
                cut = np.searchsorted(row, np.arange(n + 1)).astype(np.int32)
                hits = pa.ListArray.from_arrays(pa.array(cut), pa.StructArray.from_arrays(
                    [pa.array(pos.astype(np.int32)), pa.array(g[ok].view(np.int64))], names=["pos", "gram"]))
                some = np.diff(cut) > 0
                body = pa.array([t if s else None for t, s in zip(b.column(1).to_pylist(), some)], pa.string()) \
                    if some.any() else pa.nulls(n, pa.string())
                none = count == 0
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(np.diff(w.first).astype(np.int64)), pa.array(count),
                     pa.array(first, mask=none), pa.array(last, mask=none),
                     pa.array([",".join(sorted(x)) for x in labels]), hits, body],
                    names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "hits", "body"])

    return src.mapInArrow(run, f"doc_id {src.schema[0].dataType.simpleString()}, n_words bigint, n_base bigint, "
                               "first_word bigint, last_word bigint, base_labels string, "
                               "hits array<struct<pos:int,gram:bigint>>, body string")


def vote(scanned: DataFrame) -> DataFrame:
    """(rid, template) spans: joined grams, counted per diagonal, neighbours merged."""
    spark = scanned.sparkSession
    rows = [(int(g), i, p) for i, _, t in templates() if len(t) >= K
            for p, g in enumerate(_gram_hashes(t, K).view(np.int64))]
    table = spark.createDataFrame(rows, "gram bigint, template int, t_pos int")
    grams = scanned.where(F.size("hits") > 0).select("rid", F.explode("hits").alias("x")) \
        .select("rid", F.col("x.pos").alias("pos"), F.col("x.gram").alias("gram"))
    votes = grams.join(F.broadcast(table), "gram").groupBy("rid", "template", (F.col("pos") - F.col("t_pos")).alias("diagonal")) \
        .agg(F.count("*").alias("votes"), F.min("pos").alias("lo"), F.max("pos").alias("hi"))
    # one document can hold a notice many times: a span is a chain of close
    # diagonals, so two copies (diagonals far apart) stay two spans
    w = Window.partitionBy("rid", "template").orderBy("diagonal")
    gap = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(w) > NEIGHBOUR, F.lit(True))
    return votes.withColumn("new", gap.cast("int")).withColumn("chain", F.sum("new").over(w)) \
        .groupBy("rid", "template", "chain") \
        .agg(F.sum("votes").alias("votes"), F.min("lo").alias("lo"), (F.max("hi") + K).alias("hi"))


def verify(spans: DataFrame, scanned: DataFrame) -> DataFrame:
    """Spans with the share of the template's words that they hold in order.

    A document meets its spans as one list, so its text is moved and split once
    however many notices it holds."""
    tpl = {i: (label, t) for i, label, t in templates()}
    lists = spans.groupBy("rid").agg(F.collect_list(F.struct("template", "lo", "hi", "votes")).alias("spans"))
    withtext = lists.join(scanned.select("rid", "body"), "rid").select("rid", "spans", "body")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for rid, some, body in zip(*(c.to_pylist() for c in b.columns)):
                words = words_of(body)
                for x in some:
                    label, want = tpl[x["template"]]
                    have = words[max(0, x["lo"] - len(want)):x["hi"] + len(want)]
                    m = SequenceMatcher(None, want, have, autojunk=False)
                    share = sum(y.size for y in m.get_matching_blocks() if y.size >= 2) / len(want)
                    out.append((rid, label, x["lo"], x["hi"], x["votes"], min(1.0, share)))
            cols = list(zip(*out)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int32()),
                 pa.array(cols[3], pa.int32()), pa.array(cols[4], pa.int64()), pa.array(cols[5], pa.float64())],
                names=["rid", "label", "lo", "hi", "votes", "share"])

    return withtext.mapInArrow(run, "rid bigint, label string, lo int, hi int, votes bigint, share double") \
        .where(F.col("share") >= MIN_VERIFIED)


def license_scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: n_words, the base phrases' places, ``labels`` (base and
    verified), ``score`` (largest verified share; 1 with a base phrase) and the
    verified ``spans`` (label, first word, end word, votes, share)."""
    s = staged(scan(docs, id_col, text).withColumn("rid", F.monotonically_increasing_id()), "license-scan")
    found = verify(vote(s), s).groupBy("rid").agg(
        F.collect_set("label").alias("found"), F.max("share").alias("share"),
        F.sort_array(F.collect_list(F.struct("label", F.col("lo").alias("first_word"), F.col("hi").alias("end_word"), "votes", "share"))).alias("spans"))
    base = F.when(F.col("base_labels") == "", F.array().cast("array<string>")).otherwise(F.split("base_labels", ","))
    return s.drop("hits", "body").join(found, "rid", "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels",
        F.array_join(F.array_sort(F.array_union(base, F.coalesce("found", F.array().cast("array<string>")))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"), "spans")
