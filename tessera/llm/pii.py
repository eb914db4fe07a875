r"""Personal data: base patterns and information-theoretic sanitisation (operator 11).

Base entities are e-mail addresses, IP addresses, card and phone numbers found
by pattern.  Taking them out is not enough where the words around an entity
give it away, so corpus co-occurrence estimates what every term tells about it:
with document frequencies, the pointwise mutual information of a term and an
entity, ``log2(df(e, t) · N / (df(e) · df(t)))``, is taken from the information
content of the entity, ``log2(N / df(e))``.  The rest, ``log2(df(t) / df(e, t))``,
is the uncertainty left to a reader who sees the term.  A term that leaves
less than ``left_bits`` and was seen in ``min_contexts`` different contexts
discloses the entity: around it the term is generalised to the first half of
its characters, where that tells little enough by the same measure, and removed
otherwise.

A context is ``WINDOW`` words to either side of an entity, so a document gives
at most 2 · WINDOW terms an entity, never all pairs.  Statistics cover all
documents and whole texts; a context that copies repeat counts as one context.
Nothing passes through the driver but the number of documents.

Patterns are searched in linear time: an address is sought from its ``@``, a
run of digits only from its start, which finds the same leftmost matches.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import id_of, lean, packed, text_of
from tessera.session import materialize

KINDS = ("email", "ip", "card", "phone")
ADDED = ("generalised", "removed")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT, NOT_DIGIT = re.compile("[0-9]"), re.compile("[^0-9]")
TERM = re.compile(r"\w+")

WINDOW = 8         # words to either side of an entity
LEFT_BITS = 1.0    # uncertainty that a term must leave about an entity
MIN_CONTEXTS = 3   # different contexts that show it
SPAN = "struct<kind:string,start:bigint,end:bigint,replacement:string>"


# ---- base patterns --------------------------------------------------------------------
def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str):
    end = 0
    for m in DOMAIN.finditer(text):
        start = m.start()
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < m.start():
            end = m.end()
            yield start, end


def _at_most_255(part: str) -> bool:
    return int(part[-4:]) <= 255 and not part[:-3].strip("0")


def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, entity) of all base entities in order of start, then kind;
    offsets in code points.  The entity names equal values alike: addresses in
    lower case, numbers by their digits."""
    found = []
    if "@" in text:
        found += [(a, b, "email", text[a:b].lower()) for a, b in _emails(text)]
    if DIGIT.search(text):
        if "." in text:
            for m in IP.finditer(text):
                if all(map(_at_most_255, m.group().split("."))):
                    found.append((*m.span(), "ip", m.group()))
        for kind, pattern, low, high in (("card", CARD, 12, 19), ("phone", PHONE, 9, 15)):
            if kind == "phone" and "+" not in text:
                continue
            for m in pattern.finditer(text):
                if m.end() - m.start() < low:
                    continue
                digits = NOT_DIGIT.sub("", m.group())
                if low <= len(digits) <= high and (kind != "card" or luhn(digits)):
                    found.append((*m.span(), kind, digits))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


# ---- terms ----------------------------------------------------------------------------
def half(term: str) -> str:
    """What a term is generalised to: the first half of its characters and ``*``."""
    return term[:(len(term) + 1) // 2] + "*"


def words(text: str, spans) -> list[tuple[int, int, str]]:
    """(start, end, term) of the words outside the base spans; terms in lower case."""
    edges, at = sorted((s[0], s[1]) for s in spans), 0
    out, inside = [], 0
    for m in TERM.finditer(text):
        a, b = m.span()
        while at < len(edges) and edges[at][0] < b:
            inside = max(inside, edges[at][1])
            at += 1
        if a >= inside:
            out.append((a, b, m.group().lower()))
    return out


def contexts(text: str, spans, window: int = WINDOW) -> dict[str, tuple[bytes, list[tuple[int, int, str]]]]:
    """Per entity (``kind:value``) of a text: a digest of its contexts and the words in
    them, each place once."""
    if not spans:
        return {}
    w = words(text, spans)
    starts, at, near = [x[0] for x in w], 0, {}
    for a, b, kind, entity in spans:  # ascending starts
        while at < len(starts) and starts[at] < a:
            at += 1
        after = at
        while after < len(starts) and starts[after] < b:  # words of another span inside
            after += 1
        near.setdefault(f"{kind}:{entity}", []).append((max(0, at - window), at, after, min(len(w), after + window)))
    out = {}
    for entity, places in near.items():
        where = sorted({i for a, b, c, d in places for i in (*range(a, b), *range(c, d))})
        said = "\n".join(" ".join(w[i][2] for i in (*range(a, b), *range(c, d))) for a, b, c, d in places)
        out[entity] = hashlib.blake2b(said.encode(), digest_size=8).digest(), [w[i] for i in where]
    return out


# ---- Spark ----------------------------------------------------------------------------
def _occurrences(docs: DataFrame, id_col: str, text_col: str, window: int, row_id: Column | None) -> DataFrame:
    """Written table of one row per document: ``rid, doc_id, base`` (its spans) and
    ``near`` (per entity: entity, context, words)."""
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("replacement", pa.string())])
    word = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("term", pa.string())])
    near = pa.struct([("entity", pa.string()), ("context", pa.binary()), ("words", pa.list_(word))])

    @lean
    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, 512):
                part = b.slice(i, 512)
                base, around = [], []
                for text in part.column(2).to_pylist():
                    spans = base_spans(text)
                    base.append([{"kind": k, "start": a, "end": z, "replacement": f"<{k}>"} for a, z, k, _ in spans])
                    around.append([{"entity": e, "context": c, "words": [{"start": a, "end": z, "term": t} for a, z, t in ws]}
                                   for e, (c, ws) in contexts(text, spans, window).items()])
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(base, pa.list_(span)),
                                                  pa.array(around, pa.list_(near))], ["rid", "doc_id", "base", "near"])
    src = docs.select((F.monotonically_increasing_id() if row_id is None else row_id).alias("rid"),
                      id_of(id_col).alias("doc_id"), text_of(text_col).alias("t"))
    return materialize(src.mapInArrow(
        run, f"rid bigint, doc_id bigint, base array<{SPAN}>, near array<struct<entity:string,context:binary,"
             "words:array<struct<start:bigint,end:bigint,term:string>>>>"))


def document_frequencies(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``term, df``: documents that hold a term, or a word with that first half."""
    @lean
    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, 2_048):
                seen = Counter()
                for text in b.slice(i, 2_048).column(0).to_pylist():
                    terms = {t for _, _, t in words(text, base_spans(text))}
                    seen.update(terms)
                    seen.update(set(map(half, terms)))
                yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(seen.values(), pa.int64())],
                                                 ["term", "df"])
    return docs.select(text_of(text_col).alias("t")).mapInArrow(run, "term string, df bigint") \
        .groupBy("term").agg(F.sum("df").alias("df"))


def disclosures(occurrences: DataFrame, df: DataFrame, n_docs: int, left_bits: float = LEFT_BITS,
                min_contexts: int = MIN_CONTEXTS) -> DataFrame:
    """``entity, term, replacement`` of the terms that disclose an entity.

    Per document, entity and term one count, with its context; copies of a
    context add to the frequencies but are one context.  ``replacement`` is
    the half of the term where that leaves ``left_bits`` or more, else empty.
    """
    e = occurrences.select("rid", F.explode("near").alias("n")).select("rid", "n.entity", "n.context", "n.words")
    own = F.array_distinct(F.transform("words", lambda w: w["term"]))
    halves = F.array_distinct(F.transform(own, lambda t: F.concat(
        F.substring(t, F.lit(1), F.floor((F.length(t) + 1) / 2).cast("int")), F.lit("*"))))
    seen = e.select("entity", "context", F.explode(F.concat(own, halves)).alias("term"))
    pairs = seen.groupBy("entity", "term", "context").agg(F.count(F.lit(1)).alias("n")) \
        .groupBy("entity", "term").agg(F.sum("n").alias("df_both"), F.count(F.lit(1)).alias("contexts"))
    pairs = materialize(pairs.filter(F.col("contexts") >= min_contexts))
    left = F.log2(F.col("df") / F.col("df_both"))
    measured = materialize(pairs.join(df, "term").select("entity", "term", left.alias("left")))
    entities = e.groupBy("entity").agg(F.count(F.lit(1)).alias("df_entity"))
    telling = measured.filter((F.col("left") < left_bits) & ~F.endswith("term", F.lit("*")))
    # an entity that every document holds has no information to disclose
    telling = telling.join(entities.filter(F.col("df_entity") < n_docs).select("entity"), "entity", "left_semi")
    n = F.floor((F.length("term") + 1) / 2).cast("int")
    telling = telling.withColumn("general", F.concat(F.substring("term", F.lit(1), n), F.lit("*")))
    coarse = measured.select(F.col("entity").alias("__e"), F.col("term").alias("general"), F.col("left").alias("__left"))
    out = telling.join(coarse.withColumnRenamed("__e", "entity"), ["entity", "general"], "left")
    keeps = (F.col("__left") >= left_bits) & (F.length("general") - 1 < F.length("term"))
    return out.select("entity", "term", F.when(keeps, F.col("general")).otherwise(F.lit("")).alias("replacement"))


def _spans(docs, id_col, text_col, window, left_bits, min_contexts, row_id=None) -> DataFrame:
    occ = _occurrences(docs, id_col, text_col, window, row_id)
    told = materialize(disclosures(occ, document_frequencies(docs, text_col), occ.count(), left_bits, min_contexts))
    near = occ.select("rid", F.explode("near").alias("n")).select("rid", "n.entity", F.explode("n.words").alias("w")) \
        .select("rid", "entity", "w.start", "w.end", "w.term")
    hit = near.join(told, ["entity", "term"])
    kind = F.when(F.col("replacement") == "", ADDED[1]).otherwise(ADDED[0])
    # one place may disclose several entities: removing goes before generalising
    hit = hit.groupBy("rid", "start", "end").agg(F.min_by(F.struct(kind.alias("kind"), "replacement"),
                                                          F.length("replacement")).alias("s"))
    added = hit.groupBy("rid").agg(F.collect_list(F.struct("s.kind", "start", "end", "s.replacement")).alias("added"))
    out = occ.select("rid", "doc_id", "base").join(added, "rid", "left")
    rank = {k: i for i, k in enumerate((*KINDS, *ADDED))}
    order = F.create_map(*[F.lit(x) for kv in rank.items() for x in kv])
    every = F.transform(F.array_sort(F.transform(
        F.concat("base", F.coalesce("added", F.array().cast(f"array<{SPAN}>"))),
        lambda s: F.struct(s["start"].alias("a"), order[s["kind"]].alias("k"), s.alias("s")))), lambda x: x["s"])
    return out.select("rid", "doc_id", "base", every.alias("spans"))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
         left_bits: float = LEFT_BITS, min_contexts: int = MIN_CONTEXTS) -> DataFrame:
    """``doc_id, base, spans``, one row per input row: the base entities and all spans
    (base and added), each with kind, start, end (code points, end exclusive) and
    replacement, in order of start, then kind.

    A null or empty text has none.  Repeated rows are documents each, so copies
    count in every frequency, but their context counts once.  Extra columns are
    not read.
    """
    return _spans(docs, id_col, text_col, window, left_bits, min_contexts).select("doc_id", "base", "spans")


def cut(text: str, spans) -> str:
    """The text with spans (in order of start) replaced; overlapping spans become one,
    with the replacement of the first."""
    out, at = [], 0
    for s in spans:
        if s["start"] >= at:
            out += [text[at:s["start"]], s["replacement"]]
        at = max(at, s["end"])
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
             left_bits: float = LEFT_BITS, min_contexts: int = MIN_CONTEXTS) -> DataFrame:
    """``docs`` with all spans of ``find`` replaced in the text: entities by their kind,
    disclosing terms by their general form or nothing.  A null text stays null."""
    rows = materialize(packed(docs, __rid=F.monotonically_increasing_id()))
    src = rows.select(F.col("__rid").alias("r"), F.col("row").getField(id_col).alias("i"),
                      F.col("row").getField(text_col).alias("x"))
    found = _spans(src, "i", "x", window, left_bits, min_contexts, F.col("r")).filter(F.size("spans") > 0)
    met = rows.join(found.select(F.col("rid").alias("__rid"), "spans"), "__rid", "left")

    @lean
    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, 512):
                part = b.slice(i, 512)
                texts = [cut(t, s) if t is not None and s else t
                         for t, s in zip(part.column(1).to_pylist(), part.column(2).to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], ["row", "__text"])
    kind = rows.schema["row"].dataType.simpleString()
    met = met.select("row", F.col("row").getField(text_col).cast("string").alias("__text"), "spans") \
        .mapInArrow(run, f"row {kind}, __text string")
    return met.select(*[F.col("__text").alias(c) if c == text_col else F.col("row").getField(c).alias(c)
                        for c in docs.columns])
