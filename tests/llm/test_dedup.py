"""Near duplicates, substring dedup and fingerprints against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorewell.llm import edit_embedding as emb
from scorewell.llm import minhash_bayes as mb
from scorewell.llm import substring_dedup as sd
from scorewell.llm.components import components

from .conftest import SCHEMA, prose


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def shingles(t, k):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute_components(rows, k, percent=80):
    """Component id per row index."""
    sets = [shingles(t, k) for _i, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                up[find(a)] = find(b)
    low = {}
    for a, (i, _t) in enumerate(rows):
        if i is not None:
            low[find(a)] = min(i, low.get(find(a), i))
    return [(low.get(find(a)) if sets[a] else rows[a][0], len(sets[a])) for a in range(len(rows))]


@pytest.mark.parametrize("width", [2, 5])
def test_components_equal_brute_force(docs, rows, width):
    want = Counter((r[0], n, c) for r, (c, n) in zip(rows, brute_components([r[:2] for r in rows], width)))
    got = mb.near_duplicates(docs, width).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_stragglers_of_a_large_group(spark):
    """Near copies of one text, some of which only link to other copies."""
    rng = random.Random(2)
    base = [f"b{i}" for i in range(120)]
    rows = [(0, " ".join(base))]
    for i in range(1, 130):
        w = list(base)
        for at in rng.sample(range(120), rng.choice([1, 3, 5, 6, 7, 8, 9])):
            w[at] = f"c{i}_{at}"
        rows.append((i, " ".join(w)))
    got = {r.doc_id: r.component_id for r in mb.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), 2).collect()}
    assert [got[i] for i, _t in rows] == [c for c, _n in brute_components(rows, 2)]


def test_near_duplicates_of_nothing(none):
    assert mb.near_duplicates(none).count() == 0 and mb.keep_first(none).columns == none.columns


def test_keep_first_keeps_columns_and_one_of_equal_rows(docs, rows):
    out = mb.keep_first(docs)
    assert out.columns == docs.columns
    got = [(r.doc_id, r.text) for r in out.collect()]
    assert len(got) == len(set(got))
    comp = brute_components([r[:2] for r in rows], 5)
    assert {g[0] for g in got if g[0] is not None} == {r[0] for r, (c, _n) in zip(rows, comp) if r[0] is not None and r[0] == c}


def test_bayes_pruning_keeps_true_pairs():
    least = mb.prune_table(0.8)
    assert list(least)[-1] == mb.K and all(m < n * 0.8 for n, m in least.items())
    assert least[mb.K] > 0.55 * mb.K


def test_stars_reach_the_smallest_node(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[i] == 100 for i in range(100, 160))


def brute_removal(texts, window):
    seen = Counter()
    for t in texts:
        w = words(t)
        seen.update(tuple(w[i:i + window]) for i in range(len(w) - window + 1))
    out = []
    for t in texts:
        w = words(t)
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((len(w), len(gone), hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [sd.HOT, 1])
@pytest.mark.parametrize("window", [35, 6])
def test_substring_dedup_equals_brute_force(docs, rows, window, hot, monkeypatch):
    monkeypatch.setattr(sd, "HOT", hot)  # 1: every open segment takes the window-hash way
    monkeypatch.setattr(sd, "SHARD_WORDS", 2000)
    want = Counter((r[0], *x) for r, x in zip(rows, brute_removal([r[1] for r in rows], window)))
    got = sd.dedup(docs, window).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == want


def test_remove_repeats_changes_only_repeats(docs, none):
    out = sd.remove_repeats(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    after = {(r.doc_id, r.source): r for r in out.collect()}
    for r in docs.collect():
        a = after[r.doc_id, r.source]
        assert a.text == r.text or (len(words(a.text)) < len(words(r.text)) and a.n_chars in (len(a.text), None))
    assert sd.remove_repeats(none).count() == 0


def test_automaton_counts_places():
    rng = random.Random(1)
    for _ in range(40):
        segs = [([rng.randint(0, 3) for _ in range(rng.randint(1, 25))], rng.randint(1, 3)) for _ in range(5)]
        a = sd.SuffixAutomaton()
        for s, m in segs:
            a.add(s, m)
        a.close()
        k = rng.randint(1, 5)
        n = Counter()
        for s, m in segs:
            for i in range(len(s) - k + 1):
                n[tuple(s[i:i + k])] += m
        probe = [rng.randint(0, 4) for _ in range(30)]
        assert a.places(probe, k) == [n[tuple(probe[i:i + k])] for i in range(len(probe) - k + 1)]


def test_fingerprints(spark, docs, rows, none):
    got = emb.edited_fingerprints(docs).collect()
    order = sorted([r[:2] for r in rows], key=lambda r: (r[0] is None, -(r[0] or 0)))
    follow = {i: order[(k + 1) % len(order)][1] or "" for k, (i, _t) in enumerate(order)}
    assert len(got) == len(rows)
    fp = {}
    for r in got:
        t = next(x[1] for x in rows if x[0] == r.doc_id) or ""
        n = len(t)
        assert r.n_chars == n and r.fingerprint == emb.fingerprint(t)
        assert fp.setdefault(t, r.fingerprint) == r.fingerprint
        if r.doc_id != 5:  # the repeated row's follower is its own copy
            e = t[:n - n // 2] + follow[r.doc_id][:n // 2]
            assert r.edited_sha256 == hashlib.sha256(e.encode()).hexdigest() and r.edited_fingerprint == emb.fingerprint(e)
    assert emb.edited_fingerprints(none).count() == 0
    one = emb.edited_fingerprints(spark.createDataFrame([(3, "abcdef")], "doc_id int, text string")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_likeness_follows_edits():
    rng = random.Random(9)
    un = lambda t: emb.fingerprint(t).encode().translate(emb._UNHEX)
    near, far = [], []
    for _ in range(40):
        t = prose(rng, 300)
        near.append(emb.likeness(un(t), un(t[:200] + "!" + t[201:700] + t[703:])))
        far.append(emb.likeness(un(t), un(prose(rng, 300))))
    # walks meet again after an edit, mostly soon; a few only late
    assert sum(near) / 40 > 0.8 and sum(x > max(far) + 0.2 for x in near) >= 32 and max(far) < 0.5


def linked(pairs, nodes):
    """Smallest node reachable from each node."""
    up = {n: n for n in nodes}

    def find(n):
        while up[n] != n:
            n = up[n]
        return n
    for x, y in pairs:
        x, y = sorted((find(x), find(y)))
        up[y] = x
    return {n: find(n) for n in nodes}


def test_near_classes_against_all_pairs(spark):
    """Edited copies of texts of every length, groups with a shared opening, copies,
    null ids and empty texts: of all alike pairs at least nine in ten are connected,
    and nothing else is."""
    rng = random.Random(4)
    rows = []
    for n in (30, 60, 120, 250, 500, 2000):
        for _ in range(15):
            t = prose(rng, n, 3000)[:n]
            at = rng.randrange(n // 3, n)
            rows += [(len(rows), t), (len(rows) + 1, t[:at] + "?" + t[at + 1:])]
    opening = prose(rng, 60, 3000)
    for _ in range(10):
        t = opening + prose(rng, 120, 3000)
        rows += [(len(rows) + k, t[:500 + 40 * k] + "#!" + t[502 + 40 * k:]) for k in range(3)]
    prints = {i: emb.fingerprint(t) for i, t in rows}
    un = {i: f.encode().translate(emb._UNHEX) for i, f in prints.items()}
    alike = [(i, j) for i in un for j in un if i < j and emb.likeness(un[i], un[j]) >= 0.6]
    odd = [(9000, ""), (9001, None), (None, rows[0][1]), (9002, rows[0][1]), (9002, rows[0][1])]
    docs = spark.createDataFrame(rows + odd, "doc_id bigint, text string").repartition(4)
    fp = emb.fingerprints(docs).persist()
    got = emb.near_classes(fp).collect()
    assert len(got) == len(rows) + len(odd)
    of = {r.doc_id: r.near_class for r in got if r.doc_id is not None}
    want = linked(alike, prints)
    assert of[9000] == 9000 and of[9001] == 9001 and of[9002] == of[0] == 0
    assert {r.near_class for r in got if r.doc_id is None} == {0}
    assert sum(of[i] == of[j] for i, j in alike) >= 0.9 * len(alike) and len(alike) > 90
    short = [(i, j) for i, j in alike if len(rows[i][1]) <= 60]
    assert len(short) > 10 and sum(of[i] == of[j] for i, j in short) >= 0.9 * len(short)
    assert all(want[of[i]] == want[i] for i in prints)  # no class joins what all pairs would not
    pairs = emb.near_pairs(fp).collect()
    assert {(r.other_id, r.doc_id) for r in pairs} <= set(alike)
    assert all(r.likeness == pytest.approx(emb.likeness(un[r.doc_id], un[r.other_id])) for r in pairs)
    closed, name = linked([(r.other_id, r.doc_id) for r in pairs], prints), {}
    for i, f in prints.items():  # equal fingerprints go by their smallest id
        name.setdefault(f, i)
    assert all(closed[name[f]] == of[i] for i, f in prints.items())


def test_near_classes_of_nothing(none):
    assert emb.near_classes(emb.fingerprints(none)).count() == 0 and emb.near_pairs(emb.fingerprints(none)).count() == 0


def test_walk_equals_a_plain_loop():
    """The shared walk, character by character."""
    rng = random.Random(3)
    for _ in range(20):
        text = "".join(chr(rng.choice([97, 98, 32, 233, 20013, 128512])) for _ in range(rng.randrange(0, 300)))
        chars, at, seen = emb.classes(text), 0, []
        for c in chars:  # a character is copied out until its bit says to move on
            while True:
                seen.append(c)
                move = emb._MOVE[at % emb.PERIOD, c]
                at += 1
                if move:
                    break
        leave = emb.leave_positions(chars)
        assert (int(leave[-1]) if len(leave) else 0) == len(seen)
        digits = emb.sample(chars, leave)
        assert list(digits) == [int(emb._DIGIT[seen[p], k]) for k, p in enumerate(emb.POSITIONS) if p < len(seen)]


def test_schema_is_stable(none):
    assert none.columns == [x.split()[0] for x in SCHEMA.split(", ")]


@pytest.fixture(scope="module")
def named_alike(docs):
    """The corpus with columns named like those that the stages use inside."""
    inner = ["_kid", "_th", "kid", "th", "row", "spans", "_spans", "_q_n_words", "_t_lang", "_t_source", "_text", "set_hash", "root"]
    return docs.select("*", *[F.lit(i).alias(c) for i, c in enumerate(inner)])


def test_stages_take_any_column_names(named_alike, docs):
    from scorewell.llm import quality_sketch, substring_dedup, toxicity
    model = toxicity.Model(np.zeros(toxicity.DIMENSIONS, np.float32), -3.0)
    extra = [c for c in named_alike.columns if c not in docs.columns]
    for stage in (mb.keep_first, substring_dedup.remove_repeats, quality_sketch.keep_sound, lambda d: toxicity.keep_clean(d, model)):
        got, plain = stage(named_alike), stage(docs)
        assert got.columns == named_alike.columns and got.count() == plain.count()
        assert {tuple(r) for r in got.select(*extra).distinct().collect()} == {tuple(range(len(extra)))}
    keep = [c for c in named_alike.columns if c != "score"]
    scored = toxicity.score(named_alike, model, keep=keep)
    assert scored.columns == [*keep, "score"] and scored.where("_text <> 10").count() == 0


def test_keep_first_leaves_one_of_each_component(spark):
    """Null ids, and different texts under one id."""
    base = [f"w{i}" for i in range(100)]
    near = lambda k: " ".join(base[:k] + ["x"] + base[k + 1:])
    rows = [(None, near(3)), (None, near(50)), (None, near(99)), (None, "other words here"), (7, "seven " + near(2)), (7, "seven " + near(2))]
    got = mb.keep_first(spark.createDataFrame(rows, "doc_id bigint, text string"), width=2, percent=80).collect()
    assert sorted((r.doc_id is None, r.text[:5]) for r in got) in ([(False, "seven"), (True, "other")],)
    two = [(4, near(10)), (4, near(60)), (5, "alone " * 3), (None, ""), (None, ""), (6, None)]
    got = mb.keep_first(spark.createDataFrame(two, "doc_id bigint, text string"), width=2, percent=80).collect()
    assert sorted(str(r.doc_id) for r in got) == ["4", "5", "6", "None"]
