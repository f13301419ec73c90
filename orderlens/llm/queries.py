"""The numbered queries: each applies its operator to a whole table and derives the columns asked for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.session import ensure_utc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_utc(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """The default place of a public vocabulary; operators take it as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_packing")
def op1_packing(spark, sf_dir):
    from orderlens.llm.packing import pack

    pieces = pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), window=4096, end_id=2)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query("op8_token_files")
def op8_token_files(spark, sf_dir):
    from orderlens.llm.tokenfile import read, write

    manifest = write(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), end_id=2)
    return read(manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op10_quality_rules")
def op10_quality_rules(spark, sf_dir):
    from orderlens.llm.quality import judged

    fields = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judged(docs).select("doc_id", *[f"q.{x}" for x in fields])


@query("op2_chat_formatting")
def op2_chat_formatting(spark, sf_dir):
    from orderlens.llm.chat import format_chats, read_back

    probe = "</s>[INST] ok [/INST]"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.sql(
        "SELECT -1L AS conv_id, id AS turn, IF(id = 0, 'user', 'assistant') AS role, :t AS text FROM range(2)", {"t": probe}
    )
    windows = read_back(format_chats(rows.unionAll(extra)))
    # The digests need a whole conversation in one row; the operator's own output never does.
    entry = F.struct("window", "own_turns", "targets", F.length("formatted").alias("chars"))
    whole = windows.groupBy("conv_id").agg(F.sort_array(F.collect_list(entry)).alias("p"))
    joined = whole.select(
        "conv_id",
        F.flatten(F.transform("p", lambda x: x["own_turns"])).alias("turns"),
        F.array_join(F.flatten(F.transform("p", lambda x: x["targets"])), "").alias("loss"),
        F.aggregate("p", F.lit(0).cast("bigint"), lambda a, x: a + x["chars"]).alias("formatted_chars"),
    )
    each = F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n")))
    return joined.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(each, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


def _keyed(rows: DataFrame, key: str, to: tuple[str, str] = ("id0", "nul")) -> DataFrame:
    """The key in two columns without nulls, so that joins and groups on it share one partitioning."""
    return rows.withColumns({to[0]: F.coalesce(key, F.lit(0).cast("bigint")), to[1]: F.col(key).isNull()})


def with_edited(docs: DataFrame) -> DataFrame:
    """Each row of (doc_id, text) with ``edited``: its second half replaced by the start of the next document.

    The next document has the next larger doc_id (after the last: the smallest); where several rows hold that
    id, the smallest text counts. The text is shuffled once by its id, its start once more to the row before.
    """
    from orderlens.llm.simhash import neighbours

    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    n = F.length("text")
    halves = rows.select("doc_id", F.floor(n / 2).alias("half"))
    links = _keyed(neighbours(halves, "doc_id", "half"), "doc_id").drop("doc_id")
    rows = _keyed(rows, "doc_id")
    lent = rows.join(links, ["id0", "nul"]).select(
        "before_key", F.substring("text", F.lit(1), F.col("before_carried").cast("int")).alias("lent"), F.col("doc_id").alias("next_id")
    )
    lent = _keyed(lent, "before_key").groupBy("id0", "nul").agg(F.min(F.struct("lent", "next_id")).alias("l"))
    both = rows.join(lent.select("id0", "nul", "l.*"), ["id0", "nul"])
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("lent", F.lit(1), half))
    return both.select("id0", "nul", "doc_id", "text", n.cast("bigint").alias("n_chars"), edited.alias("edited"), "next_id")


@query("op6_simhash")
def op6_simhash(spark, sf_dir):
    from orderlens.llm.simhash import fingerprints, likeness, text_form
    from orderlens.llm.store import written

    docs = with_edited(table(spark, sf_dir, "documents").select("doc_id", "text"))
    names = ["id0", "nul", "doc_id", "next_id", "n_chars", "row", "sha"]
    numbered = docs.withColumns({"row": F.monotonically_increasing_id(), "sha": F.unhex(F.sha2("edited", 256))})
    each = F.array(*[F.struct(F.lit(e).alias("e"), F.col(c).alias("t")) for e, c in ((False, "text"), (True, "edited"))])
    both = numbered.select(*names, F.explode(each).alias("x")).select(*names, F.col("x.e").alias("e"), F.col("x.t").alias("text"))
    # All groups contain the key that the join has dealt the rows by: nothing is shuffled from here on.
    prints = fingerprints(both, [*names, "e"])
    own = prints.groupBy(*names).agg(
        F.max(F.when(~F.col("e"), F.col("bits"))).alias("bits"), F.max(F.when(F.col("e"), F.col("bits"))).alias("ebits")
    )
    own = written(own.withColumn("edited_sha256", F.lower(F.hex("sha"))), "simhash")
    following = own.groupBy(F.col("doc_id").alias("id")).agg(F.min("bits").alias("next_bits"))
    return own.join(following, F.col("next_id").eqNullSafe(F.col("id"))).select(
        "doc_id", "n_chars", "edited_sha256",
        text_form(F.col("bits")).alias("fingerprint"), text_form(F.col("ebits")).alias("edited_fingerprint"),
        likeness(F.col("bits"), F.col("ebits")).alias("near_edited"),
        likeness(F.col("bits"), F.col("next_bits")).alias("near_next"),
    )


@query("op5_byte_bpe")
def op5_byte_bpe(spark, sf_dir):
    import public_tokenizers

    from orderlens.llm.bpe import decode, encode

    own = vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    both = decode(encode(table(spark, sf_dir, "documents"), *own), *own)
    return both.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op3_ngram_jaccard")
def op3_ngram_jaccard(spark, sf_dir):
    from orderlens.llm.jaccard import linked_documents

    linked = linked_documents(table(spark, sf_dir, "documents"), size=5, percent=75)
    return linked.select("doc_id", "n_shingles", "component_id")


@query("op9_substring_dedup")
def op9_substring_dedup(spark, sf_dir):
    from orderlens.llm.chunks import without_repeats

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, x: n + x["length"])
    return without_repeats(docs).select("doc_id", "text", removed.alias("n_removed"), "spans")


def remainder(modulus: int):
    """crc32(doc_id as text) mod ``modulus``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


@query("op7_toxicity")
def op7_toxicity(spark, sf_dir):
    from orderlens.llm.toxicity import fit, score

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"), remainder(4) != 2)
    return score(docs, model).select(
        "doc_id", (remainder(4) == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


@query("op4_kneser_ney")
def op4_kneser_ney(spark, sf_dir):
    from orderlens.llm.ngram_lm import score, train

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(remainder(10) == 0, F.lit(False))
    model = train(docs.where(~held_out).select(F.col("text").cast("string").alias("text")))
    return score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known",
        F.lit(model.vocabulary.total).cast("bigint").alias("train_tokens"), F.col("unigram").alias("base_score"), "score",
    )


_OP13_SQL = r"""WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS span, array_to_string(w[k : k + least(len(w), 10) - 1], ' ') AS ws
  FROM iw, unnest(generate_series(1, CAST(len(w) - least(len(w), 10) + 1 AS BIGINT))) AS g(k) WHERE len(w) > 0),
spans AS (SELECT DISTINCT span FROM win),
dwin AS (SELECT doc_id, span, k, array_to_string(w[k : k + span - 1], ' ') AS ws
  FROM dw, spans, unnest(generate_series(1, CAST(len(w) - span + 1 AS BIGINT))) AS g(k) WHERE len(w) >= span),
occ AS (SELECT doc_id, d.span, k, item_id FROM dwin d JOIN win USING (span, ws)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT DISTINCT doc_id, span, k FROM occ), unnest(generate_series(k, k + span - 1)) AS g(p) GROUP BY 1),
its AS (SELECT doc_id, count(*) AS n, string_agg(i, ',' ORDER BY i) AS s
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM occ) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(its.n, 0) AS BIGINT) AS n_items, sha256(coalesce(its.s, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)"""


@query("op13_decontamination", _OP13_SQL)
def op13_decontamination(spark, sf_dir):
    from orderlens.llm.postings import build, search

    found = search(build(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"), size=10)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


_F12 = ", ".join(
    f"CASE WHEN {c} IS NULL THEN '-' ELSE CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR) END"
    for c in ("doc_id", "source", "lang", "n_chars", "{text}")
)
_LEAF12 = f"sha256(concat({_F12}))"
# crc32 of the decimal id, bit by bit: the last bit decides. Fixed value: the reversed polynomial 0xEDB88320.
_ODD_CRC = """list_reduce(list_concat([4294967295], list_transform(range(8 * length(d)), lambda i: CASE WHEN i % 8 = 0
  THEN 256 + ascii(substr(d, CAST(i // 8 + 1 AS INTEGER), 1)) ELSE 0 END)),
  lambda c, b: CASE WHEN xor(c, CASE WHEN b > 0 THEN b - 256 ELSE 0 END) % 2 = 1
    THEN xor(xor(c, CASE WHEN b > 0 THEN b - 256 ELSE 0 END) // 2, 3988292384) ELSE xor(c, CASE WHEN b > 0 THEN b - 256 ELSE 0 END) // 2 END)"""
_OP12_SQL = f"""WITH RECURSIVE crc AS (SELECT doc_id, {_ODD_CRC} AS c FROM (SELECT doc_id, CAST(doc_id AS VARCHAR) AS d FROM documents)),
lf AS (SELECT d.doc_id, source, {_LEAF12.format(text="text")} AS leaf,
  CASE WHEN xor(c, 4294967295) % 2 = 0 THEN {_LEAF12.format(text="replace(text, chr(10), '')")} ELSE {_LEAF12.format(text="text")} END AS claim
  FROM documents d JOIN crc USING (doc_id)),
t AS (SELECT source AS grp, 0 AS lev, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos,
  count(*) OVER (PARTITION BY source) AS n, leaf AS node FROM lf
  UNION ALL
  SELECT grp, lev + 1, pos // 3, max((n + 2) // 3), sha256(string_agg(node, '' ORDER BY pos)) FROM t WHERE n > 1 GROUP BY grp, lev + 1, pos // 3),
sub AS (SELECT grp, node AS subroot, row_number() OVER (ORDER BY grp NULLS FIRST) - 1 AS place, count(*) OVER () AS m FROM t WHERE n = 1),
u AS (SELECT 0 AS lev, place AS pos, m AS n, subroot AS node FROM sub
  UNION ALL
  SELECT lev + 1, pos // 3, max((n + 2) // 3), sha256(string_agg(node, '' ORDER BY pos)) FROM u WHERE n > 1 GROUP BY lev + 1, pos // 3),
own AS (SELECT l.*, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos FROM lf l),
-- Runs of three: the nodes of each run with their places.
tr AS (SELECT grp, lev, pos // 3 AS run, max(n) AS n, list(node ORDER BY pos) AS nodes FROM t GROUP BY 1, 2, 3),
ur AS (SELECT lev, pos // 3 AS run, max(n) AS n, list(node ORDER BY pos) AS nodes FROM u GROUP BY 1, 2),
walk AS (SELECT doc_id, source AS grp, 0 AS lev, pos, claim AS cur, '' AS sib FROM own
  UNION ALL
  SELECT w.doc_id, w.grp, w.lev + 1, w.pos // 3,
    sha256(array_to_string(list_concat(list_concat(nodes[1 : CAST(w.pos % 3 AS INTEGER)], [cur]), nodes[CAST(w.pos % 3 AS INTEGER) + 2 :]), '')),
    sib || array_to_string(list_concat(nodes[1 : CAST(w.pos % 3 AS INTEGER)], nodes[CAST(w.pos % 3 AS INTEGER) + 2 :]), '')
  FROM walk w JOIN tr ON w.grp IS NOT DISTINCT FROM tr.grp AND w.lev = tr.lev AND w.pos // 3 = tr.run WHERE tr.n > 1),
below AS (SELECT doc_id, grp, cur, sib FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY lev DESC) AS k FROM walk) WHERE k = 1),
climb AS (SELECT doc_id, 0 AS lev, place AS pos, cur, sib FROM below b JOIN sub ON b.grp IS NOT DISTINCT FROM sub.grp
  UNION ALL
  SELECT w.doc_id, w.lev + 1, w.pos // 3,
    sha256(array_to_string(list_concat(list_concat(nodes[1 : CAST(w.pos % 3 AS INTEGER)], [cur]), nodes[CAST(w.pos % 3 AS INTEGER) + 2 :]), '')),
    sib || array_to_string(list_concat(nodes[1 : CAST(w.pos % 3 AS INTEGER)], nodes[CAST(w.pos % 3 AS INTEGER) + 2 :]), '')
  FROM climb w JOIN ur ON w.lev = ur.lev AND w.pos // 3 = ur.run WHERE ur.n > 1),
top AS (SELECT doc_id, cur, sib FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY lev DESC) AS k FROM climb) WHERE k = 1),
root AS (SELECT node AS root FROM u WHERE n = 1)
SELECT o.doc_id, leaf, subroot, root, sha256(sib) AS proof_sha256, cur AS folded_root, cur = root AS verified
FROM own o JOIN top USING (doc_id) JOIN sub ON o.source IS NOT DISTINCT FROM sub.grp, root"""


@query("op12_merkle_manifest", _OP12_SQL)
def op12_merkle_manifest(spark, sf_dir):
    from orderlens.llm.merkle import build, digest, group_key, proofs

    own = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    cut = F.replace("text", F.lit("\n"), F.lit(""))
    changed = (remainder(2) == 0) & F.contains("text", F.lit("\n"))
    leaves = table(spark, sf_dir, "documents").select(
        group_key(F.col("source")).alias("grp"), "doc_id", digest(*own, F.col("text")).alias("leaf"),
        F.when(changed, digest(*own, cut)).alias("claim"),
    )
    return proofs(build(leaves)).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


_OP11_SQL = r"""WITH d AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w, row_number() OVER () AS r FROM documents),
occ AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term FROM occ GROUP BY 1, 2 HAVING count(DISTINCT r) >= 10),
grp AS (SELECT DISTINCT lang, source FROM d),
cnt AS (SELECT lang, source, term, count(*) AS c FROM occ JOIN kept USING (lang, term) GROUP BY 1, 2, 3),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY 1),
full_ AS (SELECT g.lang, g.source, k.term, coalesce(c, 0) AS c FROM grp g JOIN kept k USING (lang) LEFT JOIN cnt USING (lang, source, term)),
p AS (SELECT lang, source, term, c, CAST(1 + (CAST(1000000000 AS HUGEINT) * (c + 2)) // (sum(c) OVER (PARTITION BY lang, source) + 2 * v) AS HUGEINT) AS p
  FROM full_ JOIN v USING (lang)),
lc AS (SELECT lang, term, sum(c) AS c FROM full_ GROUP BY 1, 2),
q AS (SELECT lang, term, CAST(1 + (CAST(1000000000 AS HUGEINT) * (c + 2)) // (sum(c) OVER (PARTITION BY lang) + 2 * v) AS HUGEINT) AS q FROM lc JOIN v USING (lang)),
f AS (SELECT a.lang, a.source, b.source AS item, CAST(sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS BIGINT) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // (p + q) AS BIGINT) AS value
  FROM p JOIN q USING (lang, term) WHERE c > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10"""


@query("op11_source_divergence", _OP11_SQL)
def op11_source_divergence(spark, sf_dir):
    from orderlens.llm.divergence import audit

    return audit(table(spark, sf_dir, "documents").select("text", "lang", "source"), min_docs=10, top=10)
