"""Near copies, repeated passages, the language model, toxicity and the pipeline against brute force."""

import math
import os
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import ODD_IDS, ODD_TEXTS, corpus, documents, words
from pyspark.sql import functions as F

import corpus_pipeline
from orderlens.llm import chunks, components, jaccard, ngram_lm, quality, toxicity
from orderlens.llm import words as hashing
from orderlens.llm.queries import QUERIES, remainder
from orderlens.session import shared_dir


def groups(texts, size=5, percent=75):
    """Set sizes and the smallest row of each text's component, by comparing all pairs that share a shingle."""
    sets = []
    for t in texts:
        w = words(t)
        sets.append({tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    inverted, shared, root = defaultdict(list), Counter(), list(range(len(texts)))
    for i, s in enumerate(sets):
        for g in s:
            inverted[g].append(i)
    for own in inverted.values():
        shared.update((a, b) for k, a in enumerate(own) for b in own[k + 1 :])

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return [len(s) for s in sets], [find(i) for i in range(len(texts))]


def edited(rnd, text, k):
    w = text.split()
    for _ in range(k):
        w[rnd.randrange(len(w))] = f"new{rnd.random()}"
    return " ".join(w)


@pytest.fixture(scope="module")
def copies():
    """Texts with a chain of edits, a large group of near copies, a passage many share, and exact copies."""
    rnd = random.Random(6)

    def fresh(n):
        return " ".join(f"w{rnd.randrange(10**6)}" for _ in range(n))

    passage, chain, centre, out = fresh(60), [fresh(100)], fresh(120), []
    for _ in range(12):
        chain.append(edited(rnd, chain[-1], 2))
    out += chain + [edited(rnd, centre, rnd.randint(0, 3)) for _ in range(40)]
    out += [fresh(20) + " " + passage + " " + fresh(20) for _ in range(15)] + [fresh(80)] * 6 + [fresh(30).upper()]
    out += [out[-1].lower()] + ODD_TEXTS
    rnd.shuffle(out)
    return out


def test_join_equals_brute_force(spark, copies):
    rows = jaccard.linked_documents(documents(spark, copies).repartition(4)).collect()
    sizes, roots = groups(copies)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == {i: (n, r) for i, (n, r) in enumerate(zip(sizes, roots, strict=True))}
    assert {r.doc_id for r in rows if r.kept} == set(roots) | {i for i, n in enumerate(sizes) if not n}


def test_join_with_null_and_repeated_ids(spark):
    text = " ".join(f"t{i}" for i in range(30))
    ids = [None, 9, 9, 4, None, None]
    docs = documents(spark, [text, text, text, text + " more", None, text[::-1]], ids)
    rows = jaccard.linked_documents(docs).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in rows) == [(0, 0), (0, 0), (0, 4), (4, 4), (9, 4), (9, 4)]
    assert sum(r.kept for r in rows) == 3
    assert jaccard.linked_documents(documents(spark, [])).count() == 0


def test_join_at_the_bound_for_many_sizes(spark):
    """The longer of two texts has n shingles, the other the first k: a link from k = ceil(0.75 n) on."""
    texts, linked = [], []
    for n in (1, 2, 4, 20, 27, 39, 40, 53, 54, 80, 107, 133, 400, 1333):
        for less in (0, 1):
            k = max(1, -(-3 * n // 4) - less)
            own = [f"n{n}x{less}y{i}" for i in range(n + 4)]
            texts += [" ".join(own), " ".join(own[: k + 4])]
            linked.append(4 * k >= 3 * n)
    got = {r.doc_id: r.component_id for r in jaccard.linked_documents(documents(spark, texts)).collect()}
    assert [got[2 * i + 1] == 2 * i for i in range(len(linked))] == linked and all(got[2 * i] == 2 * i for i in range(len(linked)))


def test_join_carries_no_rows_that_meet_by_chance(spark, monkeypatch):
    """Texts that share one short passage with another do not travel; what is written on the way is deleted."""
    texts = [" ".join([f"a{i}w{k}" for k in range(200)] + [f"p{i // 2}z{k}" for k in range(6)]) for i in range(40)]
    texts += [texts[0] + " more", texts[0]]
    seen, real = {}, jaccard.written

    def counted(df, label, *args, **options):
        out = real(df, label, *args, **options)
        seen[label] = out.count()
        return out

    monkeypatch.setattr(jaccard, "written", counted)
    folder = f"{shared_dir(spark)}/orderlens"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    got = {r.doc_id: r.component_id for r in jaccard.linked_documents(documents(spark, texts)).collect()}
    assert got == {i: i for i in range(40)} | {40: 0, 41: 0}
    assert seen["jaccard-rows"] == 2
    assert [x.rsplit("-", 1)[0] for x in set(os.listdir(folder)) - before] == ["jaccard-linked"]


def test_join_query(spark, sf_dir):
    texts = corpus(sf_dir)
    ids = sorted(texts)
    sizes, roots = groups([texts[i] for i in ids])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op3_ngram_jaccard"](spark, sf_dir).collect()}
    assert got == {i: (n, ids[r]) for i, n, r in zip(ids, sizes, roots, strict=True)}


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(5, 5)]
    random.Random(1).shuffle(edges)
    found = components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r.node: r.root for r in found} == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}


def test_word_hashes_by_definition():
    texts = ODD_TEXTS + ["A b\x0bC\x0cd", "ÄÖ ä"]
    h, first = hashing.hashed_words(pa.array(texts))
    assert np.diff(first).tolist() == [len(words(t)) for t in texts]
    named = {}
    for t, a, b in zip(texts, first[:-1], first[1:], strict=True):
        for w, x in zip(words(t), h[a:b].tolist(), strict=True):
            assert named.setdefault(w, x) == x
    assert len(set(named.values())) == len(named)


def without_spans(text, spans):
    out, at = "", 0
    for s in spans:
        out += text[at : s.start]
        at = s.start + s.length
    return out + text[at:]


def test_repeated_passages_go(spark):
    rnd = random.Random(9)

    def fresh(n):
        return " ".join("".join(rnd.choice("aeioustnré") for _ in range(rnd.randint(2, 9))) for _ in range(n))

    passage = fresh(70)
    texts = [fresh(150) for _ in range(6)] + [f"{fresh(40)} {passage} {fresh(40)}" for _ in range(5)] + [None, "", "short"]
    rows = {r.doc_id: r for r in chunks.without_repeats(documents(spark, texts).repartition(3)).collect()}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        assert rows[i].text == without_spans(t or "", rows[i].spans)
        gone = sum(s.length for s in rows[i].spans)
        assert gone == 0 if not 7 <= i <= 10 else 0.6 * len(passage) < gone <= len(passage) + 2, i
        assert rows[i].lang == "en" and rows[i].own == 2 and rows[i].t == "x"
    assert chunks.without_repeats(documents(spark, [])).count() == 0


def test_copies_and_odd_rows_in_dedup(spark):
    text = "".join(f"{i * i} unlike " for i in range(100))
    rows = chunks.without_repeats(documents(spark, [text, text, text, text, None], [4, 2, None, 2, None])).collect()
    left = sorted((r.doc_id or 0, len(r.text)) for r in rows)
    assert left == [(0, 0), (0, len(text)), (2, 0), (2, 0), (4, 0)]


def test_chunks_are_content_defined():
    rnd = np.random.default_rng(3)
    text = "".join(chr(97 + x) for x in rnd.integers(0, 26, 5000))
    a, b, d, first = chunks.chunked(pa.array([text, "inserted " + text, None, ""]))
    assert first.tolist()[2:] == [len(d)] * 3
    assert b[first[1] - 1] == 5000 and a[0] == 0 and (a[1 : first[1]] == b[: first[1] - 1]).all()
    assert len(set(d[: first[1]].tolist()) - set(d[first[1] :].tolist())) <= 2


def kneser_ney(texts, held):
    """The model by definition, in dictionaries."""
    toks = [[*words(t), None] for t in texts]
    trained = [t for t, h in zip(toks, held, strict=True) if not h]
    count = Counter(w for t in trained for w in t)
    pair = Counter(p for t in trained for p in zip(["<s>", *t], t, strict=False))
    total, v = sum(count.values()), len(count)
    upper, low = Counter(pair.values()), Counter(w for _, w in pair)
    lower = Counter(low.values())
    d, e = (ngram_lm.discounts([n[i] for i in (1, 2, 3, 4)]) for n in (upper, lower))
    sums = defaultdict(lambda: [0, 0, 0, 0])
    for (a, _), k in pair.items():
        sums[a][0] += k
        sums[a][min(k, 3)] += 1
    more = sum(n for k, n in lower.items() if k > 2)

    def cut(x, k):
        return k - x[min(k, 3) - 1] if k else 0

    def word(w):
        if not pair:
            return 1 / (v + 1)
        return (cut(e, low[w]) + (e[0] * lower[1] + e[1] * lower[2] + e[2] * more) / (v + 1)) / sum(low.values())

    def after(a, w):
        if a not in sums:
            return word(w)
        s = sums[a]
        return (cut(d, pair[a, w]) + (d[0] * s[1] + d[1] * s[2] + d[2] * s[3]) * word(w)) / s[0]

    return [(len(t), sum(count[w] > 0 for w in t), sum(math.log10((count[w] + 0.1) / (total + 0.1 * (v + 1))) for w in t),
             sum(math.log10(after(a, w)) for a, w in zip(["<s>", *t], t, strict=False))) for t in toks], total


def test_language_model_query(spark, sf_dir):
    texts = corpus(sf_dir)
    ids = sorted(texts)
    held = [zlib.crc32(str(i).encode()) % 10 == 0 for i in ids]
    want, total = kneser_ney([texts[i] for i in ids], held)
    rows = {r.doc_id: r for r in QUERIES["op4_kneser_ney"](spark, sf_dir).collect()}
    for i, h, w in zip(ids, held, want, strict=True):
        r = rows[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (h, w[0], w[1], total)
        assert (r.base_score, r.score) == (pytest.approx(w[2], rel=1e-9), pytest.approx(w[3], rel=1e-9))


def test_language_model_blocks_and_odd_rows(spark, monkeypatch):
    for name in ("WORDS_PER_SHARD", "PAIRS_PER_BLOCK", "HELD"):
        monkeypatch.setattr(ngram_lm, name, 16)  # many shards, blocks and flushes
    texts = [t for t in ODD_TEXTS if len(t or "") < 1000] + ["the cat and the dog and the cat", "a cat the dog"] * 2
    docs = documents(spark, texts)
    scored = {r.doc_id: r for r in ngram_lm.score(docs, ngram_lm.train(docs.select("text").repartition(3))).collect()}
    want, _ = kneser_ney(texts, [False] * len(texts))
    for i, w in enumerate(want):
        assert (scored[i].n_tokens, scored[i].n_known) == w[:2]
        assert scored[i].score == pytest.approx(w[3], rel=1e-9)
    monkeypatch.undo()
    empty = ngram_lm.train(docs.where("false").select("text"))
    assert all(r.score == 0 for r in ngram_lm.score(docs, empty).collect())
    assert ngram_lm.score(docs.where("false"), empty).count() == 0


def test_non_negative_training_separates():
    rng = np.random.default_rng(0)
    hidden = rng.random(3000) < 0.2
    texts = [np.unique(np.concatenate((rng.integers(5, 200, 20), [rng.integers(0, 5)] if t else []))).astype(np.int64) for t in hidden]
    extra = [np.unique(np.concatenate((rng.integers(5, 200, 20), [rng.integers(0, 5)]))).astype(np.int64) for _ in range(400)]
    w, b = toxicity.train(texts + extra, np.array([False] * 3000 + [True] * 400), 200, 0.2, 1)
    z = np.array([w[t].sum() + b for t in texts])
    assert (z[hidden] > -0.8).mean() > 0.9 and (z[~hidden] < -0.8).mean() > 0.95


def test_toxicity_finds_held_out_words(spark):
    rnd = random.Random(2)
    toxic = [rnd.random() < 0.25 for _ in range(1200)]
    texts = [" ".join([f"w{rnd.randrange(300)}" for _ in range(30)] + ([rnd.choice(["Vile!", "awful"])] if t else [])) for t in toxic]
    docs = documents(spark, texts + ODD_TEXTS, [*range(1200)] + ODD_IDS).repartition(3)
    labels = spark.createDataFrame([(i, int(t)) for i, t in enumerate(toxic) if i % 2] + [(None, 1), (8, None)], "doc_id bigint, toxic int")
    scored = toxicity.score(docs, toxicity.fit(docs, labels, remainder(4) != 2)).select("doc_id", "score", "own").collect()
    assert len(scored) == 1209 and all(0 <= r.score <= 1 and r.own == 2 for r in scored)
    rest = [r for r in scored if r.doc_id is not None and r.doc_id < 1200 and zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    hit = [(r.score >= 0.3) == toxic[r.doc_id] for r in rest if r.doc_id > 8]
    assert sum(hit) > 0.95 * len(hit)


def test_toxicity_without_labels(spark):
    docs = documents(spark, ["a b", None])
    model = toxicity.fit(docs, spark.createDataFrame([], "doc_id bigint, toxic int"), F.lit(True))
    assert [r.score for r in toxicity.score(docs, model).collect()] == [0.0, 0.0]
    assert toxicity.score(documents(spark, []), model).count() == 0


def test_toxicity_sample_is_bounded_in_rows(spark, monkeypatch):
    """One positive and one unlabelled id on most rows: each id is learned from once."""
    texts = [f"vile w{i % 7}" for i in range(40)] + [f"fine w{i % 9}" for i in range(160)]
    ids = [1] * 30 + [*range(2, 12)] + [12] * 60 + [*range(13, 113)]
    docs = documents(spark, texts, ids)
    labels = spark.createDataFrame([(i, int(i < 12)) for i in range(1, 113)], "doc_id bigint, toxic int")
    seen = []
    train = toxicity.train
    monkeypatch.setattr(toxicity, "train", lambda texts, positive, *rest: seen.append(positive) or train(texts, positive, *rest))
    toxicity.fit(docs, labels, F.lit(True), positives=5, unlabelled=1000)
    assert {(int(p.sum()), int((~p).sum())) for p in seen} == {(5, 112)}
    few = toxicity.fit(docs, labels, F.lit(True), positives=100, unlabelled=1000, most_unlabelled=None)
    scored = {(r.text, r.score) for r in toxicity.score(docs, few).collect()}
    assert min(s for t, s in scored if "vile" in t) > max(s for t, s in scored if "fine" in t)


def test_toxicity_scores_once_and_names_its_column(spark):
    model = toxicity.Model(np.full(toxicity.SIZE, -1, np.int32), np.zeros((1, 1)), np.array([0.0]), 0.5)
    docs = documents(spark, ["a", None, "b" * 5_000_000]).withColumn("Score", F.lit("mine"))
    with pytest.raises(ValueError, match="score"):
        toxicity.score(docs, model)
    kept = toxicity.score(docs, model, out="s").where("s >= 0.5 AND s < 0.6").select("Score", "s", (F.col("s") * 2).alias("t"))
    assert [tuple(r) for r in kept.collect()] == [("mine", 0.5, 1.0)] * 3
    assert kept._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_vector_counts_are_whole():
    from orderlens.llm import vectors

    wide = np.zeros(vectors.PART + 3, np.uint32)
    wide[[0, vectors.PART + 2]] = 70_000, 9
    raw = [np.frombuffer(zlib.decompress(r["counts"]), f"<u{k}") for r, k in zip(vectors.parts(wide), (4, 2), strict=True)]
    assert raw[0][0] == 70_000 and raw[1][2] == 9


def test_toxicity_query(spark, sf_dir):
    rows = QUERIES["op7_toxicity"](spark, sf_dir).collect()
    assert len(rows) == len(corpus(sf_dir))
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == int(r.score >= 0.3)


def test_pipeline_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf_dir)
        path = str(tmp_path / str(number))
        out.write.parquet(path)
        before, out = {r.doc_id: r for r in docs.collect()}, spark.read.parquet(path)
        if number < 4:
            assert sorted(out.columns) == sorted(columns)
            after = {r.doc_id: r for r in out.collect()}
            assert set(after) <= set(before) and all(r.n_chars == len(r.text) for r in after.values())
        if name == "toxicity":
            assert all(after[i] == before[i] for i in after) and len(after) > 0.8 * len(before)
        elif name == "quality rules":
            judged = {r.doc_id: r for r in quality.judged(docs).select("doc_id", "q.*").collect()}
            assert {i: r.text for i, r in after.items()} == {i: r.cleaned for i, r in judged.items() if r.kept}
        elif name == "near copies":
            ids = sorted(before)
            sizes, roots = groups([before[i].text for i in ids])
            assert after == {ids[r]: before[ids[r]] for r in {*roots, *(i for i, n in enumerate(sizes) if not n)}}
        elif name == "substring dedup":
            assert all(len(after[i].text) <= len(before[i].text) for i in after) and len(after) >= 0.9 * len(before)
        else:
            rows = sorted(out.collect(), key=lambda r: r.sequence_id)
            assert [r.n_tokens for r in rows[:-1]] == [4096] * (len(rows) - 1)
            assert {i for r in rows for i in r.doc_ids} == set(before)
        docs = out


def test_pipeline_of_an_empty_table(spark, sf_dir, tmp_path):
    spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{sf_dir}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_chunks_of_a_text_do_not_depend_on_its_place_in_a_batch():
    rnd = random.Random(11)
    texts = ["".join(rnd.choice("abcdefghij k") for _ in range(300)) for _ in range(200)]
    a, b, d, first = chunks.chunked(pa.array(texts))
    for k, text in enumerate(texts):
        i, j = first[k], first[k + 1]
        alone = chunks.chunked(pa.array([text]))
        assert [x.tolist() for x in alone[:3]] == [a[i:j].tolist(), b[i:j].tolist(), d[i:j].tolist()]


def test_pipeline_leaves_the_rows_of_its_stages_only(spark, sf_dir):
    folder = f"{shared_dir(spark)}/orderlens"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    out = corpus_pipeline.run(spark, sf_dir)
    left = {x.rsplit("-", 1)[0] for x in set(os.listdir(folder)) - before}
    assert left == {f"pipeline-{name.replace(' ', '-')}" for name, _ in corpus_pipeline.STAGES}
    assert out.count() > 0


def test_near_copies_when_the_table_is_split_anew(spark, tmp_path, monkeypatch):
    """Files dealt to other partitions between the linking and the last read lose no document and keep no copy."""
    texts = [" ".join(f"w{i}x{k}" for k in range(30)) for i in range(12)]
    documents(spark, texts + texts).repartition(6).write.parquet(f"{tmp_path}/docs")
    link = jaccard.linked_documents
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {name: spark.conf.get(name, None) for name in names}

    def split(size, number):
        for name, value in zip(names, (size, "0", number), strict=True):
            spark.conf.set(name, value)

    def then_split(*args, **options):
        out = link(*args, **options)
        split("256b", "64")
        return out

    monkeypatch.setattr(jaccard, "linked_documents", then_split)
    try:
        split("1g", "1")
        kept = corpus_pipeline.drop_near_copies(spark, spark.read.parquet(f"{tmp_path}/docs"), str(tmp_path)).collect()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    assert sorted(r["doc_id"] for r in kept) == list(range(12))
