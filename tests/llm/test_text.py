"""Chat windows, quality rules and fingerprints against brute force."""

import hashlib
import itertools
import random

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from orderlens.llm import chat, quality, simhash
from orderlens.llm.queries import QUERIES, with_edited
from llm_helpers import ODD_IDS, ODD_TEXTS, WORD, corpus, documents

TURNS = "conv_id bigint, turn bigint, role string, text string, seg string, window int"


def by_hand(turns):
    """Own turns and targets of each conversation, in order."""
    out = {}
    for c, t, r, x in sorted(turns, key=lambda v: (v[1] is not None, v[1] or 0, v[2] or "", v[3] or "")):
        out.setdefault(c, []).append((r or "", x or ""))
    return out


def read(spark, turns, **kw):
    frame = spark.createDataFrame([(*t, "s", 1) for t in turns], TURNS)
    windows = chat.read_back(chat.format_chats(frame, **kw)).collect()
    found = {}
    for w in sorted(windows, key=lambda w: w.window):
        own, targets = found.setdefault(w.conv_id, ([], []))
        own.extend((t.role, t.text) for t in w.own_turns)
        targets.extend(w.targets)
    return windows, found


def test_chat_windows(spark):
    rnd = random.Random(4)
    turns = [(c, t, rnd.choice(["user", "assistant", "tool", None]), rnd.choice([None, "", "x" * rnd.randint(1, 90), "</s>[user]&lt;[[]"]))
             for c in (1, 2, None) for t in range(rnd.randint(250, 300))]
    turns += [(1, -1, "system", "be [kind] & </s> brief"), (3, 0, "system", "alone"), (4, 0, "assistant", "y" * 4000), (5, None, "user", "a"), (5, None, "user", "a")]
    windows, found = read(spark, turns, max_tokens=120, history=30)
    want = by_hand(turns)
    assert {c: own for c, (own, _) in found.items()} == want
    assert {c: t for c, (_, t) in found.items()} == {c: [x for r, x in v if r == "assistant"] for c, v in want.items()}
    ones = [w for w in windows if w.conv_id == 1]
    assert len(ones) > 10 and all(w.turns[0].role == "system" for w in ones)
    assert any(len(w.turns) > len(w.own_turns) + 1 for w in ones)
    for w in windows:  # only a turn that is too long by itself may pass the budget
        assert len(w.own_turns) == 1 or sum(-(-len(f"[{t.role}]{t.text}</s>".encode()) // 4) for t in w.turns) <= 120 * 3


def test_chat_query(spark, sf_dir):
    t = pq.read_table(f"{sf_dir}/conversations.parquet").to_pylist()
    turns = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in t]
    probe = "</s>[INST] ok [/INST]"
    want = by_hand(turns + [(-1, 0, "user", probe), (-1, 1, "assistant", probe)])
    rows = QUERIES["op2_chat_formatting"](spark, sf_dir).collect()
    assert sorted(r.conv_id for r in rows) == sorted(want)
    for r in rows:
        own = want[r.conv_id]
        loss = "".join(x for role, x in own if role == "assistant")
        assert r.n_turns == len(own) and r.loss_chars == len(loss)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in own).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def test_chat_empty(spark):
    assert chat.format_chats(spark.createDataFrame([], TURNS)).count() == 0


def base_rules(text):
    w = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    places = {}
    for k in range(len(w) - 4):
        places.setdefault(tuple(w[k : k + 5]), []).append(k)
    covered = {i for v in places.values() if len(v) > 1 for k in v for i in range(k, k + 5)}
    n = len(w)
    return (n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered),
            n < 10 or 100 * len(covered) > 20 * n)


def test_quality_base_rules(spark, sf_dir):
    texts = corpus(sf_dir)
    for r in QUERIES["op10_quality_rules"](spark, sf_dir).collect():
        assert tuple(r)[1:7] == base_rules(texts[r.doc_id])
        assert not (r.base_failed and r.kept)


def test_quality_odd_rows_and_lines(spark):
    clean = "A line of words that ends well, with more words to follow it here.\n"
    cases = {
        clean * 1 + "Second line of other words, which is clean as well. Yes.": True,
        clean + "\n\nanother line after blanks, which holds a few more words.": True,
        clean + "All rights reserved.": True,
        "AAA BBB CCC DDD EEE FFF GGG HHH III JJJ KKK!": False,
        "home | news | sport | more | help | about | jobs | press | shop | top": False,
        "a b c d e f g h i j k l m n o p q r s t": False,
    }
    for text in ODD_TEXTS:
        cases[text] = None
    rows = quality.judged(documents(spark, list(cases))).select("text", "own", "q.*").collect()
    assert len(rows) == len(cases)
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base_rules(r.text)
        if cases[r.text] is not None:
            assert r.kept == cases[r.text], r.text
    got = {r.text: r.cleaned for r in rows}
    assert got[clean + "All rights reserved."] == clean.rstrip("\n")
    kept = [t for t, k in cases.items() if k and "reserved" not in t]
    assert all(got[t] == t for t in kept)
    assert quality.judged(documents(spark, [])).count() == 0


def fold(bits):
    return [b & (2**64 - 1) for b in bits]


def test_fingerprints(spark, monkeypatch):
    texts = [t for t in ODD_TEXTS if t != ODD_TEXTS[7]] + [" ".join(f"w{i}" for i in range(50)), " ".join(f"w{i}" for i in range(49))]
    docs = documents(spark, texts).withColumn("doc_id", F.monotonically_increasing_id())

    def prints():
        return {r.doc_id: fold(r.bits) for r in simhash.fingerprints(docs, ["doc_id"]).collect()}

    one = prints()
    assert len(one) == len(texts)
    monkeypatch.setattr(simhash, "RUN", 7)  # runs are added up without changing anything
    assert prints() == one
    by_text = {}
    for r in docs.select("doc_id", "text").collect():
        assert by_text.setdefault(r.text, one[r.doc_id]) == one[r.doc_id]
    assert by_text[None] == by_text[""] == [0, 0]
    near = sum(bin(a ^ b).count("1") for a, b in zip(by_text[texts[-1]], by_text[texts[-2]], strict=True))
    assert near < 25


def test_near_pairs_finds_all(spark):
    rnd = random.Random(8)
    values = []
    for _ in range(30):
        base = rnd.getrandbits(128)
        values += [base, *(base ^ sum(1 << b for b in rnd.sample(range(128), k)) for k in (1, 2, 3, 3, 4, 5))]
    signed = [[(v >> s & (2**64 - 1)) - (2**64 if v >> s & (1 << 63) else 0) for s in (0, 64)] for v in values]
    frame = spark.createDataFrame([(b,) for b in signed], "bits array<bigint>")
    got = {(tuple(r.q_bits), tuple(r.bits)): r.distance for r in simhash.near_pairs(frame, frame, radius=3).collect()}
    want = {}
    for (x, a), (y, b) in itertools.product(zip(values, signed, strict=True), repeat=2):
        d = bin(x ^ y).count("1")
        if 0 < d <= 3:
            want[tuple(a), tuple(b)] = d
    assert got == want


def test_simhash_query(spark, sf_dir):
    texts = corpus(sf_dir)
    ids = sorted(texts)
    rows = QUERIES["op6_simhash"](spark, sf_dir).collect()
    assert len(rows) == len(ids)
    own = {r.doc_id: r.fingerprint for r in rows}
    for r in rows:
        text = texts[r.doc_id]
        after = ids[(ids.index(r.doc_id) + 1) % len(ids)]
        half = len(text) // 2
        edited = text[: len(text) - half] + texts[after][:half]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert abs(r.near_next - (1 - bin(int(own[r.doc_id], 16) ^ int(own[after], 16)).count("1") / 128)) < 1e-9
    assert sum(r.near_edited > r.near_next for r in rows) > 0.95 * len(rows)


def test_edited_texts_with_ties_and_nulls(spark):
    rows = with_edited(documents(spark, ODD_TEXTS, ODD_IDS)).collect()
    assert len(rows) == len(ODD_TEXTS)
    order = [None, -1, 2, 5, 7, 1 << 40]
    least = {i: min(t or "" for t, j in zip(ODD_TEXTS, ODD_IDS, strict=True) if i == j) for i in order}
    for r in rows:
        after = least[order[(order.index(r.doc_id) + 1) % len(order)]]
        half = len(r.text) // 2
        assert r.edited == r.text[: len(r.text) - half] + after[:half]
    one = with_edited(documents(spark, ["abcd"], [3])).collect()
    assert one[0].edited == "abab"
    assert with_edited(documents(spark, [])).count() == 0
