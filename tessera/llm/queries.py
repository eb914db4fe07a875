"""Registered queries of the training-data operators, and their DuckDB SQL.

Each query applies one operator with production parameters to the whole of its
table and derives the digest columns of its contract from the operator's real
output.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

BPE_FILE = "byte_bpe_50k.json"


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def bpe_path() -> str:
    return public_tokenizers.path(BPE_FILE)


@query
def op1_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every text, decode the ids again, digest both."""
    from tessera.llm import bpe
    out = bpe.encode(table(spark, sf_dir, "documents"), bpe_path(), public_tokenizers.PATTERN, with_decoded=True)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every text; long ones are spliced from overlapping chunks."""
    from tessera.llm import token_counts
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), bpe_path(), public_tokenizers.PATTERN)


N_SHARDS = 16


@query
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen equal shards by rendezvous hashing of doc_id, and the shard among seventeen."""
    from tessera.llm import sharding
    out = sharding.assign(table(spark, sf_dir, "documents"), [1.0] * N_SHARDS,
                          grown_weights=[1.0] * (N_SHARDS + 1))
    return out.withColumn("law", F.lit("key"))


@query
def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Format every conversation and one that spells control strings; read all back."""
    from tessera.llm import chat
    tricky = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)],
                                  "conv_id bigint, turn bigint, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    back = chat.read_back(chat.format_chats(turns.unionByName(extra)))
    said = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("bigint").alias("n_turns"),
                       F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
                       F.length("loss_text").cast("bigint").alias("loss_chars"),
                       F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
                       F.length("formatted").cast("bigint").alias("formatted_chars"))


ORACLES["op9_chat_formatting"] = r"""
WITH raw AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
marked AS (
  SELECT *, replace(replace(role, '\', '\\'), '<|', '<\|') AS erole,
         replace(replace(text, '\', '\\'), '<|', '<\|') AS etext,
         lag(role) OVER w IS DISTINCT FROM role AS opens,
         lead(role) OVER w IS DISTINCT FROM role AS closes
  FROM raw WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(etext) + CASE WHEN opens THEN 16 + length(erole) ELSE 8 END
                + CASE WHEN closes THEN 8 ELSE 0 END) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
"""


@query
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of byte-equal texts; the largest doc_id of each stays."""
    from tessera.llm import exact_dedup
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


ORACLES["op2_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""


@query
def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash of four-word shingles; components of links of at most four bits."""
    from tessera.llm import simhash
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return out.select("doc_id", simhash.hex_of("fp").alias("fingerprint"), "component_id")


@query
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix all sources to weights 5, 2, 1 at 150 % of all words, none above twice its size."""
    from tessera.llm import mixing
    return mixing.mix(table(spark, sf_dir, "documents"), (5, 2, 1), 1.5, 2.0)


ORACLES["op7_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || '/mix') AS h FROM documents),
s AS (
  SELECT source, sum(size) AS source_size,
         [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS w
  FROM d GROUP BY source),
f AS (
  SELECT *, (1.5 * sum(source_size) OVER ()
             - coalesce(sum(2.0 * source_size) OVER (ORDER BY 2.0 * source_size / w, source
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (ORDER BY 2.0 * source_size / w, source
                           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM s),
t AS (SELECT source, source_size::BIGINT AS source_size,
             least(2.0 * source_size, max(level) OVER () * w)::DOUBLE AS target FROM f),
p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS take,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id, d.size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(greatest(0, least(start + size, take) - start)
            + greatest(0, least(start + size + source_size, take) - (start + source_size)) AS BIGINT) AS taken
FROM p
"""


@query
def op7_mixing_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same mix as pieces of documents at their slots."""
    from tessera.llm import mixing
    return mixing.interleave(table(spark, sf_dir, "documents"), (5, 2, 1), 1.5, 2.0)


@query
def op8_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I-Match signatures of every text, of its edited text, and their likeness."""
    from tessera.llm import imatch
    out = imatch.compare_edits(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_chars", F.sha2(F.col("edited_text").cast("binary"), 256).alias("edited_sha256"),
                      F.concat_ws("", "sigs").alias("fingerprint"),
                      F.concat_ws("", "edited_sigs").alias("edited_fingerprint"), "near_edited", "near_next")


TOXIC_AT, QUALITY_AT = 0.3, 0.5


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text, learned from the labels outside fold 2 of 4."""
    from tessera.llm import labelled, toxicity
    docs = table(spark, sf_dir, "documents")
    out = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels"), 4, 2))
    return out.select("doc_id", (labelled.remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
                      (F.col("score") >= TOXIC_AT).cast("int").alias("predicted"))


@query
def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every text, learned from the labels outside fold 1 of 3."""
    from tessera.llm import labelled, quality_net
    docs = table(spark, sf_dir, "documents")
    out = quality_net.score(docs, quality_net.fit(docs, table(spark, sf_dir, "labels"), 3, 1))
    return out.select("doc_id", (labelled.remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
                      (F.col("score") >= QUALITY_AT).cast("int").alias("predicted"))


@query
def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights of all documents towards the benchmark texts, and the 5 % drawn."""
    from tessera.llm import resample
    return resample.importance(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), share=5)


LEAF_COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle trees per language under one root; a seventh of the rows claims one
    character more than it has."""
    from tessera.llm import merkle
    docs = table(spark, sf_dir, "documents")
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 0
    claims = {"n_chars": F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    out = merkle.manifest(docs, LEAF_COLUMNS, "lang", claims=claims)
    return out.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root",
                      F.sha2(F.col("siblings").cast("binary"), 256).alias("proof_sha256"), "folded_root",
                      (F.col("folded_root") == F.col("root")).alias("verified"))


def _joined(spans):
    """``kind:start:end`` of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@query
def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every text by pattern, and the terms around it that give it away."""
    from tessera.llm import pii
    out = pii.find(table(spark, sf_dir, "documents"))

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return out.select("doc_id", *[count(k) for k in pii.KINDS],
                      F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                      _joined(F.col("spans")).alias("spans"))


def _crc32_sql(hex_text: str) -> str:
    """DuckDB SQL: CRC-32 of the bytes whose hex digits are ``hex_text`` (a column).
    The checksum is linear, so a table entry is the sum of those of its bits."""
    one_bit = []
    for i in range(8):
        v = 1 << i
        for _ in range(8):
            v = v >> 1 ^ (0xEDB88320 if v & 1 else 0)
        one_bit.append(v)
    step = "(a >> 8)"
    for i, v in enumerate(one_bit):
        step = f"xor({step}, ((xor(a & 255, b) >> {i}) & 1) * {v})"
    data = f"list_transform(range(0, length({hex_text}) // 2), lambda i: CAST('0x' || substr({hex_text}, 2 * i + 1, 2) AS BIGINT))"
    return f"xor(list_reduce({data}, lambda a, b: {step}, CAST(4294967295 AS BIGINT)), 4294967295)"


def _leaf_sql(n_chars: str) -> str:
    values = ["doc_id", "source", "lang", n_chars, "text"]
    parts = [f"coalesce(octet_length(encode(CAST({v} AS VARCHAR))) || ':' || CAST({v} AS VARCHAR), '-')" for v in values]
    return f"sha256({' || '.join(parts)})"


ORACLES["op12_merkle_manifest"] = f"""
WITH RECURSIVE ids AS (SELECT *, hex(encode(CAST(doc_id AS VARCHAR))) AS id_hex FROM documents),
seen AS (SELECT *, n_chars + CAST({_crc32_sql('id_hex')} % 7 = 0 AS INTEGER) AS told FROM ids),
leaves AS (SELECT doc_id, lang, {_leaf_sql('n_chars')} AS leaf, {_leaf_sql('told')} AS claimed FROM seen),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, claimed) - 1 AS pos,
              count(*) OVER (PARTITION BY lang) AS n FROM leaves),
nodes AS (
  SELECT lang, 0 AS lvl, pos, n, leaf AS h FROM placed
  UNION ALL
  SELECT lang, lvl + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM nodes WHERE n > 1 GROUP BY lang, lvl, pos // 2, n),
subs AS (SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS lvl, pos, n, h FROM subs
  UNION ALL
  SELECT lvl + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM tops WHERE n > 1 GROUP BY lvl, pos // 2, n),
steps AS (
  SELECT a.lang, a.pos, l.lvl, (a.pos >> l.lvl) & 1 AS side, s.h AS sib
  FROM placed a JOIN (SELECT DISTINCT lang, lvl FROM nodes WHERE n > 1) l ON a.lang IS NOT DISTINCT FROM l.lang
  LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM a.lang AND s.lvl = l.lvl AND s.pos = xor(a.pos >> l.lvl, 1)
  UNION ALL
  SELECT a.lang, a.pos, 1000 + l.lvl, (g.pos >> l.lvl) & 1, s.h
  FROM placed a JOIN subs g ON a.lang IS NOT DISTINCT FROM g.lang JOIN (SELECT DISTINCT lvl FROM tops WHERE n > 1) l ON true
  LEFT JOIN tops s ON s.lvl = l.lvl AND s.pos = xor(g.pos >> l.lvl, 1)),
paths AS (SELECT lang, pos, list(side || coalesce(sib, '') ORDER BY lvl) AS path, coalesce(string_agg(sib, '' ORDER BY lvl), '') AS sibs
          FROM steps GROUP BY lang, pos),
done AS (
  SELECT a.doc_id, a.leaf, g.h AS subroot, (SELECT h FROM tops WHERE n = 1) AS root, sha256(coalesce(p.sibs, '')) AS proof_sha256,
         coalesce(list_reduce(p.path, lambda x, s: sha256(CASE WHEN s[1] = '1' THEN s[2:] || x ELSE x || s[2:] END), a.claimed),
                  a.claimed) AS folded_root
  FROM placed a JOIN subs g ON a.lang IS NOT DISTINCT FROM g.lang
  LEFT JOIN paths p ON p.lang IS NOT DISTINCT FROM a.lang AND p.pos = a.pos)
SELECT *, folded_root = root AS verified FROM done
"""


def _words_sql(texts: str) -> str:
    """DuckDB SQL: ``r, f``, every run of 1 to 3 words of the texts of a table with ``r``."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return f"""
  WITH x AS (SELECT r, unnest(w) AS w1, generate_subscripts(w, 1) AS i
             FROM (SELECT r, regexp_extract_all({lower}, '{word}') AS w FROM {texts})),
  n AS (SELECT r, w1, lead(w1) OVER o AS w2, lead(w1, 2) OVER o AS w3 FROM x WINDOW o AS (PARTITION BY r ORDER BY i))
  SELECT r, 1 AS words, w1 AS f FROM n UNION ALL SELECT r, 0, w1 || ' ' || w2 FROM n WHERE w2 IS NOT NULL
  UNION ALL SELECT r, 0, w1 || ' ' || w2 || ' ' || w3 FROM n WHERE w3 IS NOT NULL"""


ORACLES["op13_importance_resampling"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
b AS (SELECT row_number() OVER () AS r, text FROM benchmark),
df AS ({_words_sql('d')}), bf AS ({_words_sql('b')}),
hashed AS (SELECT f, {_crc32_sql('h')} % 10000 AS k
           FROM (SELECT DISTINCT f, hex(encode(f)) AS h FROM (SELECT f FROM df UNION ALL SELECT f FROM bf))),
s AS (SELECT k, count(*) AS n FROM df JOIN hashed USING (f) GROUP BY k),
t AS (SELECT k, count(*) AS n FROM bf JOIN hashed USING (f) GROUP BY k),
g AS (SELECT a.k, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM s) + 10000)
             / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + 10000)))) AS gain
      FROM range(0, 10000) a(k) LEFT JOIN s ON s.k = a.k LEFT JOIN t ON t.k = a.k),
w AS (SELECT r, sum(words) AS words, count(*) AS n_features, sum(gain) AS weight
      FROM df JOIN hashed USING (f) JOIN g USING (k) GROUP BY r),
z AS (SELECT doc_id, coalesce(words, 0) AS words, coalesce(n_features, 0) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
             CAST('0x' || substr(sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 8) AS BIGINT) AS h
      FROM d LEFT JOIN w USING (r)),
c AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5) / 4294967296))) AS BIGINT) AS score FROM z),
o AS (SELECT *, CASE WHEN words >= 20 THEN row_number() OVER (PARTITION BY words >= 20 ORDER BY score DESC, doc_id) END AS place FROM c)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score,
       CASE WHEN place <= (SELECT 5 * count(*) // 100 FROM o WHERE words >= 20) THEN place END AS rank FROM o
"""
