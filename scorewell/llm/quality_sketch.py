"""Quality rules with adaptive thresholds from mergeable quantile sketches.

``rule_features`` measures every whole text.  ``thresholds`` builds one KLL
sketch per (language, source) and rule in a single aggregate: map tasks sketch
their own rows, sketches merge at the reducer, so a source holding a third of
all rows costs the reducer a few kilobytes per map task.  Sketches also merge up to
the language and to the whole corpus (without re-reading rows), and a group's
quantiles are a weighted mean of the three that leans on its own the more rows it
has, so no size switches a verdict.  ``apply_rules`` joins the thresholds back and
decides.

A fence climbs the upper quantiles of the sketch (``LEVELS``).  Each level puts
it at the median plus a multiple of the level's own distance to the median, plus
a small margin; the climb goes on only while the next quantile lies within the
fence so far.  A long but connected tail thus widens its fence, and junk that
stands apart (up to a quarter of the group) does not.  Where three
quarters have a share of 0 and the rest stands apart, the fence is the margin.

Defined results: null or empty text has no words (base rules fail it); null
language or source is a group of its own (null-safe join); repeated rows are
measured and returned separately; an empty table gives an empty result; only
the named columns are read, so other columns' names cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from scorewell.llm.common import staged, unused
from scorewell.llm.textbytes import PLAIN_WORD, Words, byte_class, pieces

SYMBOL = ~byte_class(b"#*$%&|<>")
LINE = byte_class(b"\n")
COUNTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]

#: rule -> (value from the counts, side, margin): a document fails above the
#: upper fence ("high"), or also below its mirror ("both").  Up to two repeated
#: lines are no sign in a text of any length (a share of three lines is a third).
RULES = {
    "symbol_share": ("n_symbols / greatest(n_words, 1)", "high", 0.02),
    "repeat_share": ("n_repeat_words / greatest(n_words, 1)", "high", 0.02),
    "dup_line_share": ("greatest(n_dup_lines - 2, 0) / greatest(n_lines, 1)", "high", 0.1),
    "mean_word_chars": ("word_chars / greatest(n_words, 1)", "both", 0.8),
}
#: the quantiles that a fence climbs, and the multiple of each one's distance to
#: the median that reaches as far as six standard deviations of a normal tail
LEVELS = (0.75, 0.8, 0.85, 0.9, 0.95, 0.975, 0.99)
REACH = [6 / NormalDist().inv_cdf(p) for p in LEVELS]
LEAN = 20         # a group of so many rows weighs as much as its language
SKETCH_K = 800    # rank error under 0.5 %, so that the upper levels are told apart


def _row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    c = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=c[1:])
    return c[offsets[1:]] - c[offsets[:-1]]


def measure(column: pa.Array) -> dict[str, np.ndarray]:
    """The counts of ``COUNTS`` for each text of a column."""
    w = Words(column, PLAIN_WORD)
    wordy = PLAIN_WORD[w.data]
    out = {"n_words": np.diff(w.first),
           "word_chars": _row_sums(wordy & ((w.data & 0xC0) != 0x80), w.offsets),
           "n_symbols": _row_sums(SYMBOL[w.data], w.offsets)}
    lines = Words(column, LINE)
    in_words = np.zeros(len(wordy) + 1, np.int64)
    np.cumsum(wordy, out=in_words[1:])
    with_word = in_words[lines.end] > in_words[lines.start]
    key = lines.hashes()[with_word]
    row = lines.row[with_word]
    out["n_lines"] = np.bincount(row, minlength=w.rows)
    order = np.lexsort((key, row))
    again = (key[order][1:] == key[order][:-1]) & (row[order][1:] == row[order][:-1])
    out["n_dup_lines"] = np.bincount(row[order][1:][again], minlength=w.rows)
    gram, at = w.grams(w.hashes(), 3)
    covered = np.zeros(len(w), bool)
    if len(gram):
        order = np.lexsort((gram, w.row[at]))
        g, r = gram[order], w.row[at][order]
        same = (g[1:] == g[:-1]) & (r[1:] == r[:-1])
        twice = np.zeros(len(g), bool)
        twice[1:] |= same
        twice[:-1] |= same
        hit = at[order[twice]]
        for k in range(3):
            covered[hit + k] = True
    out["n_repeat_words"] = np.bincount(w.row[covered], minlength=w.rows)
    return out


def rule_features(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                  lang: str = "lang", source: str = "source") -> DataFrame:
    """doc_id, lang, source and the counts, one row per input row."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(lang).alias("lang"),
                      F.col(source).alias("source"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in pieces(batch):
                m = measure(b.column(3))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), b.column(2)] + [pa.array(m[c].astype(np.int64)) for c in COUNTS],
                    names=["doc_id", "lang", "source", *COUNTS])

    head = src.schema
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in head.fields[:3])
    return src.mapInArrow(run, schema + "".join(f", {c} bigint" for c in COUNTS))


def base_failed():
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _climb(mid: Column, quantiles: list[Column], margin: float) -> Column:
    """The upper fence over the quantiles at ``LEVELS``."""
    at = lambda q, reach: mid + reach * (q - mid) + margin
    steps = F.array(*[F.struct(q.alias("q"), F.lit(c).alias("reach")) for q, c in zip(quantiles[1:], REACH[1:])])

    def step(acc: Column, x: Column) -> Column:
        on = acc["on"] & (x["q"] <= acc["fence"])
        return F.struct(F.when(on, F.greatest(acc["fence"], at(x["q"], x["reach"]))).otherwise(acc["fence"]).alias("fence"), on.alias("on"))

    start = F.struct(at(quantiles[0], F.lit(REACH[0])).alias("fence"), F.lit(True).alias("on"))
    return F.aggregate(steps, start, step, lambda acc: acc["fence"])


def thresholds(features: DataFrame, lean: int = LEAN) -> DataFrame:
    """Fences per (lang, source): ``<rule>_low`` / ``<rule>_high`` and the group's size.

    A group of n rows has weight n / (n + ``lean``), the rest goes to its language,
    and what that leaves by the same rule to everything."""
    sound = features.where(~base_failed())
    g = sound.groupBy("lang", "source").agg(
        F.count("*").alias("n"),
        *[F.kll_sketch_agg_double(F.expr(e).cast("double"), F.lit(SKETCH_K)).alias(f"s_{r}")
          for r, (e, *_rest) in RULES.items()])

    def merged(keys: list[str], tag: str) -> DataFrame:
        return g.groupBy(*keys).agg(
            F.sum("n").alias(f"n_{tag}"),
            *[F.kll_merge_agg_double(f"s_{r}", F.lit(SKETCH_K)).alias(f"{tag}_{r}") for r in RULES])

    by_lang = merged(["lang"], "lang").withColumnRenamed("lang", "of_lang")
    whole = merged([], "all")
    j = g.join(by_lang, F.col("lang").eqNullSafe(F.col("of_lang")), "left").join(F.broadcast(whole), F.lit(True), "left")
    cols = []
    own, own_lang = (F.col(c) / (F.col(c) + lean) for c in ("n", "n_lang"))
    ranks = F.array(*[F.lit(p) for p in (0.5, *LEVELS, *[1 - p for p in LEVELS])])
    for r, (_e, side, margin) in RULES.items():
        at = [F.kll_sketch_get_quantile_double(F.col(f"{of}_{r}"), ranks) for of in ("s", "lang", "all")]
        j = j.withColumn(f"q_{r}", F.zip_with(at[0], F.zip_with(at[1], at[2], lambda x, y: own_lang * x + (1 - own_lang) * y),
                                              lambda x, y: own * x + (1 - own) * y))
        q = [F.col(f"q_{r}")[i] for i in range(2 * len(LEVELS) + 1)]
        cols.append(_climb(q[0], q[1:len(LEVELS) + 1], margin).alias(f"{r}_high"))
        low = -_climb(-q[0], [-x for x in q[len(LEVELS) + 1:]], margin) if side == "both" else F.lit(None).cast("double")
        cols.append(low.alias(f"{r}_low"))
    return j.select("lang", "source", F.col("n").alias("group_n"), *cols)


def apply_rules(features: DataFrame, fences: DataFrame) -> DataFrame:
    """Counts plus ``base_failed``, ``failed_rules`` (names) and ``kept``.

    The fences have one row per (lang, source) of the corpus: a few per
    language and source, joined null-safe; Spark broadcasts them only under its
    own measured size threshold and otherwise sorts and merges with skew splits.
    """
    t = fences.select(F.col("lang").alias("t_lang"), F.col("source").alias("t_source"),
                      *[c for c in fences.columns if c not in ("lang", "source")])
    j = features.join(t, F.col("lang").eqNullSafe(F.col("t_lang")) & F.col("source").eqNullSafe(F.col("t_source")), "left")
    fails = []
    for r, (e, side, _m) in RULES.items():
        v = F.expr(e).cast("double")
        bad = v > F.col(f"{r}_high")
        if side == "both":
            bad = bad | (v < F.col(f"{r}_low"))
        fails.append(F.when(bad, F.lit(r)))
    return j.select("doc_id", "lang", "source", *COUNTS, base_failed().alias("base_failed"),
                    F.array_compact(F.array(*fails)).alias("failed_rules")) \
        .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


def quality_filter(docs: DataFrame, **names: str) -> DataFrame:
    """Features, fences from all rows, joined verdict: one row per input row.

    The features are staged, so the texts are read and measured once for both
    the sketches and the verdict."""
    f = staged(rule_features(docs, **names), "quality-features")
    return apply_rules(f, thresholds(f))


def keep_sound(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """The rows, with all their columns, that pass the base rules and the fences
    of their language and source.

    The texts are measured once for the sketches and once more beside the rows,
    which is cheaper than moving the texts to join a verdict.  Null and empty texts
    fail the base rules; repeated rows are judged each; an empty table gives an empty
    result; any column names will do."""
    fences = staged(thresholds(rule_features(docs, id_col=docs.columns[0], lang=lang, source=source, text=text)), "fences")
    q, t = unused("_q_", docs.columns), unused("_t_", docs.columns)
    at, names = docs.columns.index(text), [f"{q}{c}" for c in COUNTS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in pieces(batch, text):
                m = measure(b.column(at))
                yield pa.RecordBatch.from_arrays(b.columns + [pa.array(m[c].astype(np.int64)) for c in COUNTS],
                                                 names=b.schema.names + names)

    measured = docs.mapInArrow(run, StructType(docs.schema.fields + [StructField(n, LongType()) for n in names]))
    fails = F.lit(False)
    for r, (e, side, _m) in RULES.items():
        v = F.expr(re.sub(r"\b(" + "|".join(COUNTS) + r")\b", rf"{q}\1", e)).cast("double")
        fails = fails | F.coalesce(v > F.col(f"{t}{r}_high"), F.lit(False))
        if side == "both":
            fails = fails | F.coalesce(v < F.col(f"{t}{r}_low"), F.lit(False))
    base = (F.col(f"{q}n_words") < 50) | (100 * F.col(f"{q}n_repeat_words") > 50 * F.col(f"{q}n_words"))
    of = fences.select(*[F.col(c).alias(f"{t}{c}") for c in fences.columns])
    return measured.join(of, F.col(lang).eqNullSafe(F.col(f"{t}lang")) & F.col(source).eqNullSafe(F.col(f"{t}source")), "left") \
        .where(~base & ~fails).select(*[F.col(f"`{c}`") for c in docs.columns])
