"""Divergence audit, Merkle manifest and decontamination against brute force on small tables."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from orderlens.llm import divergence, merkle, postings
from orderlens.llm.queries import QUERIES
from llm_helpers import LOWER, ODD_IDS, ODD_TEXTS, documents

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, grp string, term string, item string, pos string"
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ALPHA = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def alnum(text):
    return ALNUM.findall((text or "").translate(LOWER))


def table(spark, rows):
    """Rows (doc_id, text, lang, source, n_chars) and columns that clash with names used inside."""
    return spark.createDataFrame([(*r, "g", "t", "i", "p") for r in rows], SCHEMA)


# ---- decontamination ----------------------------------------------------------------------------------------


def exact(doc, items, size):
    own, hit, found = alnum(doc), set(), set()
    for item, text in items:
        words = alnum(text)
        span = min(size, len(words))
        for k in range(len(words) - span + 1 if words else 0):
            for s in range(len(own) - span + 1):
                if own[s : s + span] == words[k : k + span]:
                    hit |= set(range(s, s + span))
                    found.add("" if item is None else str(item))
    return len(own), len(hit), sorted(found), hit


def near(doc, items, size, width):
    own, found = alnum(doc), set()
    for item, text in items:
        words = alnum(text)
        span = min(size, len(words))
        for k in range(len(words) - span + 1 if words else 0):
            if any(set(words[k : k + span]) <= set(own[s : s + width]) for s in range(len(own))):
                found.add("" if item is None else str(item))
    return sorted(found)


def test_phrases_and_proximity_against_brute_force(spark):
    rnd = random.Random(5)
    some = ["a", "B", "c", "é", "中文", "x1", "7"]
    texts = [" ".join(rnd.choice(some) for _ in range(rnd.randint(0, 30))) for _ in range(80)]
    texts += [texts[3], texts[3], None, "", "?!", "a" + " b" * 3000 + " c é"]
    items = [(i % 25, " ".join(rnd.choice(some) for _ in range(rnd.randint(0, 9)))) for i in range(40)]
    items += [(None, "b b b c"), (None, None), (99, ""), (100, items[0][1]), (101, "absent words only")]
    docs = table(spark, [(i // 2 or None, t, "en", "s", 0) for i, t in enumerate(texts)])
    index = postings.build(docs, limit=150)
    assert index.count() > 3
    tests = spark.createDataFrame(items, "item_id bigint, text string")
    got = [r for r in postings.search(index, tests, size=4, width=6).collect()]
    expected = []
    for i, t in enumerate(texts):
        n, hits, names, places = exact(t, items, 4)
        expected.append((i // 2 or None, n, hits, names, near(t, items, 4, 6), sorted(places)))
    key = lambda r: (str(r[0]), r[1], r[2], r[3], r[4], r[5])
    found = [
        (r.doc_id, r.n_words, r.n_hit, r["items"], r.near_items, [p for s in r.spans for p in range(s.start, s.start + s.length)])
        for r in got
    ]
    assert sorted(found, key=key) == sorted(expected, key=key)


def test_windows_in_many_blocks_give_the_same(spark, monkeypatch):
    rnd = random.Random(6)
    texts = [" ".join(rnd.choice("abcd") for _ in range(25)) for _ in range(30)]
    items = spark.createDataFrame([(i, texts[i][4:20]) for i in range(0, 30, 3)], "item_id bigint, text string")
    index = postings.build(table(spark, [(i, t, None, None, None) for i, t in enumerate(texts)]))
    whole = postings.search(index, items, 5, 7).orderBy("doc_id").collect()
    monkeypatch.setattr(postings, "CANDIDATES", 3)
    whole_addresses = postings.windows(items, 5)
    monkeypatch.setattr(postings, "windows", lambda rows, size: parts)
    parts = windows_of(items, 5, 4)
    assert len(parts) > len(whole_addresses)
    assert postings.search(index, items, 5, 7).orderBy("doc_id").collect() == whole


windows_of = postings.windows


def test_no_documents_or_no_items(spark):
    none = table(spark, [])
    items = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    assert postings.search(postings.build(none), items).collect() == []
    index = postings.build(table(spark, [(1, "a b c", None, None, None), (2, None, None, None, None)]))
    got = sorted(postings.search(index, items.limit(0)).select("doc_id", "n_words", "n_hit", "items").collect())
    assert [tuple(r) for r in got] == [(1, 3, 0, []), (2, 0, 0, [])]


def test_one_very_common_word(spark):
    """A third of all words is one word, and windows consist of it alone."""
    docs = table(spark, [(i, "the " * 50 + f"w{i} end", None, None, None) for i in range(200)])
    items = spark.createDataFrame([(1, "the the the"), (2, "the " * 12), (3, "end the"), (4, "the w7 end")], "item_id bigint, text string")
    got = {r.doc_id: r for r in postings.search(postings.build(docs), items, size=10, width=10).collect()}
    assert all(r.n_hit >= 50 and {"1", "2"} <= set(r["items"]) for r in got.values())
    assert got[7]["items"] == ["1", "2", "4"] and got[7].n_hit == 52 and got[8]["items"] == ["1", "2"]
    assert "3" in got[8].near_items and "4" not in got[8].near_items


# ---- Merkle manifest ----------------------------------------------------------------------------------------


def h(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text):
    doc_id, _, lang, source, n_chars = row
    fields = [None if x is None else str(x) for x in (doc_id, source, lang, n_chars, text)]
    return h("-" if f is None else f"{len(f.encode())}:{f}" for f in fields)


def tree(leaves, arity):
    """Levels from the leaves to the root."""
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([h(out[-1][i : i + arity]) for i in range(0, len(out[-1]), arity)])
    return out


def siblings(levels, at, arity):
    out = []
    for nodes in levels[:-1]:
        start = at - at % arity
        out.append((at - start, [x for i, x in enumerate(nodes[start : start + arity], start) if i != at]))
        at //= arity
    return out


def brute_manifest(rows, claims, arity):
    groups = defaultdict(list)
    for row, claim in zip(rows, claims, strict=True):
        groups[row[3]].append((row[0] is not None, row[0] or 0, leaf_of(row, row[1]), row[0], claim))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    below = {g: tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])], arity) for g in order}
    above = tree([below[g][-1][0] for g in order], arity)
    out = []
    for place, g in enumerate(order):
        for at, (_, _, leaf, doc_id, claim) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            path = siblings(below[g], at, arity) + siblings(above, place, arity)
            folded = claim or leaf
            for slot, own in path:
                folded = h([*own[:slot], folded, *own[slot:]])
            proof = h(s for _, own in path for s in own)
            out.append((doc_id, leaf, below[g][-1][0], above[-1][0], proof, folded, folded == above[-1][0]))
    return sorted(out, key=str)


def manifest_rows(spark, rows, claims, shape):
    from pyspark.sql import functions as F

    docs = table(spark, rows)
    plain = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    claimed = spark.createDataFrame([(i, c) for i, c in enumerate(claims)], "i int, c string")
    numbered = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, doc_id bigint, text string, lang string, source string, n_chars bigint") if rows else docs.withColumn("i", F.lit(0))
    leaves = numbered.join(claimed, "i").select(
        merkle.group_key(F.col("source")).alias("grp"), "doc_id", merkle.digest(*plain, F.col("text")).alias("leaf"), F.unhex("c").alias("claim")
    )
    names = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r) for r in merkle.proofs(merkle.build(leaves, shape)).select(*names).collect()), key=str)


@pytest.mark.parametrize("arity,depth", [(3, 9), (3, 2), (2, 1)])
def test_manifest_against_brute_force(spark, arity, depth):
    """Null and repeated ids, equal rows, ids far apart, negative ids, null groups, groups of one, blocks of few slots."""
    rnd = random.Random(arity * 10 + depth)
    rows = [(i, t, "en", "odd", 3) for i, t in zip(ODD_IDS, ODD_TEXTS, strict=True)]
    rows += [(rnd.choice([1, -1]) * rnd.randrange(1 << rnd.randrange(1, 63)), f"t{i}\n", "de", "wide", i) for i in range(60)]
    rows += [(i, f"line\n{i}", None, None, None) for i in range(30)]
    rows += [(77, f"same id {i % 9}", "en", "one id", 1) for i in range(40)]
    rows += [(-(1 << 63), "low", "en", "ends", 1), ((1 << 63) - 1, "high", "en", "ends", 1), (None, "none", "en", "ends", 1)]
    rows += [(5, "alone", "en", "", 1), (6, "alone", "en", "é", 1), (7, "alone", "en", "Z", 1)]
    claims = [leaf_of(r, r[1].replace("\n", "")) if r[1] and "\n" in r[1] and i % 2 else None for i, r in enumerate(rows)]
    assert manifest_rows(spark, rows, claims, merkle.Shape(arity, depth)) == brute_manifest(rows, claims, arity)


def test_manifest_of_one_row_and_of_none(spark):
    row = (1, "text", "en", "s", 4)
    (only,) = manifest_rows(spark, [row], [None], merkle.Shape())
    leaf = leaf_of(row, "text")
    assert only == (1, leaf, leaf, leaf, h([]), leaf, True)
    assert manifest_rows(spark, [], [], merkle.Shape()) == []


def test_crowded_containers_are_dealt_in_pieces(spark, monkeypatch):
    """A third of all rows has one id: its container is copied to several pieces, places stay gapless."""
    rows = [(9, f"x{i % 50}", "en", "s", 1) for i in range(100)] + [(i, "y", "en", "s", 1) for i in range(200)]
    monkeypatch.setattr(merkle, "CONTAINER", 64)
    monkeypatch.setattr(merkle, "BITS", 6)
    monkeypatch.setattr(merkle, "LISTED", 4)
    none = [None] * len(rows)
    assert manifest_rows(spark, rows, none, merkle.Shape()) == brute_manifest(rows, none, 3)


def test_ranks_by_population_counts():
    rnd = np.random.default_rng(3)
    for n in (1, 200, 300, 4000):
        low = np.sort(rnd.choice(merkle.CONTAINER, n, replace=False))
        raw = merkle.pack_container(low)
        assert merkle.members(raw).tolist() == low.tolist()
        asked = np.arange(merkle.CONTAINER)
        empty = merkle.pack_container(low[:0])
        assert merkle.Ranks(raw, empty, b"").below(asked).tolist() == np.searchsorted(low, asked).tolist()


# ---- divergence ---------------------------------------------------------------------------------------------


def brute_audit(rows, min_docs, top):
    df, n, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source, _ in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = ALPHA.findall((text or "").translate(LOWER))
        df[lang].update(set(terms))
        n[lang, source].update(terms)
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, c in df[lang].items() if c >= min_docs]
        sources = sorted(s for x, s in groups if x == lang)

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (counts[t] + 2) // (total + 2 * len(kept)) for t in kept}

        whole = shares(sum((n[lang, s] for s in sources), Counter()))
        own = {s: shares(n[lang, s]) for s in sources}
        price = lambda p, q: (p - q) ** 2 // (p + q)
        for s in sources:
            pairs = [(sum(price(own[s][t], own[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(price(own[s][t], whole[t]), t) for t in kept if n[lang, s][t] and own[s][t] > whole[t]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:limit]
                out += [(lang, s, part, item, v, r) for r, (v, item) in enumerate(ranked, 1)]
    return sorted(out)


@pytest.mark.parametrize("levels,tile", [(12, 64), (2, 64)])
def test_audit_against_brute_force(spark, monkeypatch, levels, tile):
    monkeypatch.setattr(divergence, "LEVELS", levels)
    rnd = random.Random(levels)
    some = [f"w{c}" for c in "abcdefghijklmnop"] + ["É", "中文", "it's", "x9y", "ß"]
    langs, sources = ["en", "de", None, ""], ["s1", "s2", "S3", None, "é"]
    rows = [
        (i, " ".join(rnd.choices(some, range(1, 22), k=rnd.randint(0, 12))), rnd.choice(langs), rnd.choice(sources), 1)
        for i in range(160)
    ]
    rows += [(1, None, "fr", "a", None), (1, "", "fr", "b", None), (None, " 123 ", "fr", None, None), (2, "un mot", "it", "solo", 1)]
    rows += [(i, t, "odd", "s", 0) for i, t in zip(ODD_IDS, ODD_TEXTS, strict=True)] + [(1, "word word", "odd", "other", 0)]
    got = divergence.audit(table(spark, rows), min_docs=3, top=4)
    assert sorted(tuple(r) for r in got.collect()) == brute_audit(rows, 3, 4)
    assert divergence.audit(table(spark, [])).collect() == []


def test_many_sources_are_dealt_in_tiles(spark):
    rnd = random.Random(8)
    rows = [(i, " ".join(rnd.choices("abcdef", k=6)), "en", f"s{i % 70}", 1) for i in range(210)]
    got = divergence.audit(table(spark, rows), min_docs=2, top=3)
    assert sorted(tuple(r) for r in got.collect()) == brute_audit(rows, 2, 3)


def test_shares_are_exact_for_large_counts():
    rnd = random.Random(1)
    for _ in range(200):
        total, terms = rnd.randrange(1, 8 * 10**15), rnd.randrange(1, 10**6)
        count = rnd.randrange(0, total + 1)
        expected = 1 + 1_000_000_000 * (count + 2) // (total + 2 * terms)
        assert divergence.shares(np.array([count]), np.array([total]), terms).tolist() == [expected]


def test_equal_subtrees_are_one_node_and_met_once():
    counts = np.array([[1, 0, 0, 0, 1, 0, 0, 0], [2, 0, 0, 0, 2, 0, 0, 0], [1, 0, 0, 0, 1, 0, 0, 0]])
    forest = divergence.Forest(counts)
    assert forest.roots[0] == forest.roots[2]
    assert [len(c) for c in forest.children] == [3, 2, 2]
    which, a, b, times = forest.meetings(np.array([0]), np.array([1]))
    assert sorted(zip(a.tolist(), b.tolist(), times.tolist(), strict=True)) == [(0, 0, 6), (1, 2, 2)]


def test_tally_flushes_without_loss(monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 5)
    texts = ["a b c d", "e f g h", "a a a"] * 7
    batch = pa.record_batch([pa.array(["x", "y", "x"] * 7), pa.array(["s"] * 21), pa.array(texts)], names=["lang", "source", "text"])
    sums = Counter()
    for out in divergence._counted(iter([batch.slice(i, 1) for i in range(21)])):
        for r in out.to_pylist():
            sums[r["lang"], r["term"]] += r["n"]
    assert sums["x", "a"] == 28 and sums["y", "e"] == 7 and sums["x", None] == 0


def test_registered_queries_run_on_odd_rows(spark, tmp_path):
    """Null ids, texts and columns, repeats and very long texts through the queries themselves."""
    docs = documents(spark, ODD_TEXTS, ODD_IDS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "Same text here"), (None, None)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    hits = {(r.doc_id, r.n_hit) for r in QUERIES["op13_decontamination"](spark, str(tmp_path)).collect()}
    assert {(7, 3), (5, 0), (-1, 0)} <= hits
    rows = QUERIES["op12_merkle_manifest"](spark, str(tmp_path)).collect()
    assert len(rows) == len(ODD_IDS) and any(not r.verified for r in rows) and any(r.verified for r in rows)
    assert QUERIES["op11_source_divergence"](spark, str(tmp_path)).collect() == []
