"""Personal data and the terms that give it away (operator 4).

Mails, addresses, card and phone numbers are found by pattern and verified. Around each, the words within a window are
its context. Over the whole corpus it is counted in how many different texts an entity stands, in how many of them a term
stands in a context of it, and in how many different texts the term stands at all. Pointwise mutual information against
the information of the entity itself says how strongly the term discloses it:

    disclosure(c, t) = log(N n(c, t) / (n(c) n(t))) / log(N / n(c))

which is 1 if the term never stands without the entity. Terms above a threshold are generalised, above a higher one
removed, in the windows of that entity. All of these count copies of a text once. Terms seen in fewer than
``min_contexts`` different contexts of an entity are left alone, so that a context copied into a thousand texts discloses
nothing by that alone.

Defined results: a null text holds nothing and stays null; repeated rows are found each; an empty table gives an empty
result; further columns are kept.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countertide.llm.common import BROADCAST_ROWS, sized, slices, table
from countertide.llm.registry import query
from countertide.plans.shared import freeze

KINDS = ("email", "ip", "card", "phone")
REMOVED, GENERALISED = "term_removed", "term_generalised"

# The patterns of the contract. A look-behind saves starts inside a run that failed from its beginning.
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"[^\W\d_]{4,}")
_SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


@dataclass(frozen=True)
class Disclosure:
    window: int = 6  # words on either side of an entity
    min_contexts: int = 3
    generalise: float = 0.90
    remove: float = 0.97


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Each match holds one @, so each @ is tried once, with the letters before it back to the last match or @."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        head = text[free:at]
        start = free + len(head.rstrip(_LOCAL))
        free = at + 1
        tail = _DOMAIN.match(text, at + 1) if start < at else None
        if tail:
            found.append((start, tail.end()))
            free = tail.end()
        at = text.find("@", free)
    return found


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind, then start."""
    out = [("email", a, b) for a, b in emails(text)]
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


def joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _hash(*parts: str) -> int:
    return int.from_bytes(hashlib.blake2b("\x1f".join(parts).encode(), digest_size=8).digest(), "big", signed=True)


def contexts(text: str, spans, window: int) -> list[tuple[int, int, str, int, int]]:
    """(entity, context, term, start, end) for the terms around each span; what touches a span is no term."""
    if not spans:
        return []
    places = sorted((a, b) for _, a, b in spans)
    words = [(m.start(), m.end()) for m in _SPLIT.finditer(text)]
    starts = [a for a, _ in words]
    out = []
    from bisect import bisect_left, bisect_right

    for kind, a, b in spans:
        first, last = bisect_right(starts, a) - 1, bisect_left(starts, b)
        near = words[max(0, first - window) : max(0, first)] + words[last : last + window]
        context = _hash(*[text[x:y] for x, y in near])
        entity = _hash(kind, text[a:b])
        for x, y in near:
            k = bisect_right(places, (x, len(text) + 1)) - 1
            if (k >= 0 and places[k][1] > x) or (k + 1 < len(places) and places[k + 1][0] < y):
                continue
            m = _WORD.search(text, x, y)
            if m:
                out.append((entity, context, m[0].lower(), m.start(), m.end()))
    return out


_SPAN = pa.list_(pa.struct([("entity", pa.int64()), ("context", pa.int64()), ("term", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
FOUND = "n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base string, near array<struct<entity:bigint,context:bigint,term:string,start:bigint,end:bigint>>"


def _finder(window: int):
    def find(batches):
        for batch in batches:
            kept = [n for n in batch.schema.names if n != "_text"]
            for part in slices(batch, "_text"):
                texts = part.column("_text").to_pylist()
                spans = [base_spans(t) if t else [] for t in texts]
                counts = [Counter(k for k, _, _ in s) for s in spans]
                near = [[dict(zip(("entity", "context", "term", "start", "end"), x)) for x in contexts(t, s, window)] if s else [] for t, s in zip(texts, spans)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[part.column(n) for n in kept],
                        *[pa.array([c[k] for c in counts], pa.int64()) for k in KINDS],
                        pa.array([joined(s) for s in spans], pa.string()),
                        pa.array(near, _SPAN),
                    ],
                    names=[*kept, *[f"n_{k}" for k in KINDS], "base", "near"],
                )

    return find


def find(docs: DataFrame, window: int, text: str = "text") -> DataFrame:
    """``docs`` without the text, with counts, base spans and the terms near them."""
    kept = [c for c in docs.columns if c != text]
    source = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").cast("string").alias("_text"))
    schema = source.drop("_text").schema
    for f in docs.sparkSession.createDataFrame([], FOUND).schema.fields:
        schema = schema.add(f.name, f.dataType, True)
    return source.mapInArrow(_finder(window), schema)


def _term_counter(wanted):
    """Documents that hold a term, by the number of copies of their texts, summed by slice. ``wanted``: the terms to count, or None for all."""

    def count(batches):
        terms = None if wanted is None else wanted.value
        for batch in batches:
            for part in slices(batch, "_text"):
                by_copies: dict[int, Counter] = {}
                for t, copies in zip(part.column("_text").to_pylist(), part.column("_copies").to_pylist()):
                    if t:
                        # The same words as in contexts(): the first run of letters of each word.
                        words = {m[0] for w in set(_SPLIT.findall(t.lower())) if (m := _WORD.search(w))}
                        by_copies.setdefault(copies, Counter()).update(words if terms is None else words & terms)
                for copies, n in by_copies.items():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(n), pa.string()), pa.array([copies] * len(n), pa.int64()), pa.array(list(n.values()), pa.int64())],
                        names=["term", "copies", "n"],
                    )

    return count


def disclosing(docs: DataFrame, near: DataFrame, texts: DataFrame, settings: Disclosure, text: str = "text") -> DataFrame:
    """(entity, term, kind) of the terms that disclose an entity.

    ``near``: of a written table, (same, entity, context, term), where ``same`` is a hash of the text. ``texts``: a written table of
    (same, copies), one row for each different text of ``docs``.
    """
    often = near.select("entity", "term", "context").distinct().groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_contexts"))
    pairs = freeze(often.filter(F.col("n_contexts") >= settings.min_contexts).select("entity", "term"), "pairs")
    n_pairs = pairs.count()
    if not n_pairs:  # nothing is seen often enough, whatever the terms' own counts are
        return pairs.select("entity", "term", F.lit(REMOVED).alias("kind"))
    wanted = None
    if n_pairs <= BROADCAST_ROWS:
        wanted = docs.sparkSession.sparkContext.broadcast({r.term for r in pairs.select("term").distinct().collect()})
    both = near.select("entity", "term", "same").distinct().groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_both"))
    source = docs.select(F.col(f"`{text}`").cast("string").alias("_text")).withColumn("_same", F.xxhash64("_text"))
    several = freeze(texts.filter("copies > 1").select(F.col("same").alias("_same"), F.col("copies").alias("_copies")), "copied_texts")
    source = source.join(sized(several), "_same", "left").select("_text", F.coalesce("_copies", F.lit(1)).cast("long").alias("_copies"))
    # Each text of so many copies is met so many times: whole numbers.
    terms = source.mapInArrow(_term_counter(wanted), "term string, copies bigint, n bigint").groupBy("term", "copies").agg(F.sum("n").alias("n"))
    terms = terms.groupBy("term").agg(F.sum(F.expr("n div copies")).alias("n_term"))
    entities = near.select("entity", "same").distinct().groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"))
    total = texts.count()
    scored = pairs.join(both, ["entity", "term"]).join(terms, "term").join(entities, "entity").filter(F.col("n_entity") < total)
    score = F.log(F.lit(float(total)) * F.col("n_both") / (F.col("n_entity") * F.col("n_term"))) / F.log(F.lit(float(total)) / F.col("n_entity"))
    return scored.select("entity", "term", score.alias("score")).filter(F.col("score") >= settings.generalise).select(
        "entity", "term", F.when(F.col("score") >= settings.remove, REMOVED).otherwise(GENERALISED).alias("kind")
    )


def sanitise_spans(docs: DataFrame, settings: Disclosure = Disclosure(), text: str = "text", keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keys``, ``n_*``, ``base`` (base spans) and ``spans`` (all of them): a written table, one row for each row of ``docs``."""
    # A row is known by its keys and its text, so that rows of one id with other texts stay apart.
    row = docs.select(*[F.col(f"`{k}`") for k in keys], F.xxhash64(*[F.col(f"`{k}`") for k in keys], F.col(f"`{text}`")).alias("row"), F.xxhash64(F.col(f"`{text}`").cast("string")).alias("same"), F.col(f"`{text}`").alias("text"))
    found = freeze(find(row, settings.window), "private")
    near = found.filter(F.size("near") > 0).select("row", "same", F.explode("near").alias("x")).select("row", "same", "x.*")
    texts = freeze(found.groupBy("same").agg(F.count(F.lit(1)).alias("copies")), "different_texts")
    told = freeze(disclosing(docs, near, texts, settings, text), "disclosing")
    terms = (
        near.join(told, ["entity", "term"])
        .select("row", "kind", "start", "end")
        .groupBy("row", "start", "end")
        .agg(F.max("kind").alias("kind"))  # removed wins over generalised
        .groupBy("row")
        .agg(F.sort_array(F.collect_list(F.struct(F.when(F.col("kind") == GENERALISED, 0).otherwise(1).alias("o"), "start", "end", "kind"))).alias("terms"))
    )
    more = F.array_join(F.transform("terms", lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    # Exactly the spans of one text meet in a group: as bounded as the text itself.
    return found.drop("near").join(terms, "row", "left").select(
        *[F.col(f"`{k}`") for k in keys], "row", *[f"n_{k}" for k in KINDS], "base",
        F.concat_ws(",", F.when(F.col("base") != "", F.col("base")), more).alias("spans"),
    )


def _cleaner(batches):
    names = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", REMOVED: "[...]"}
    for batch in batches:
        kept = [n for n in batch.schema.names if n not in ("_text", "_spans")]
        for part in slices(batch, "_text"):
            texts = []
            for text, spans in zip(part.column("_text").to_pylist(), part.column("_spans").to_pylist()):
                if text and spans:
                    out, at = [], 0
                    for start, end, kind in sorted((int(a), int(b), k) for k, a, b in (s.split(":") for s in spans.split(","))):
                        if start >= at:
                            word = text[start:end]
                            out += [text[at:start], names.get(kind) or ("[Name]" if word[:1].isupper() else "[word]")]
                        at = max(at, end)
                    text = "".join(out) + text[at:]
                texts.append(text)
            yield pa.RecordBatch.from_arrays([*[part.column(n) for n in kept], pa.array(texts, pa.string())], names=[*kept, "_clean"])


def sanitise(docs: DataFrame, settings: Disclosure = Disclosure(), text: str = "text", keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``docs`` with spans of personal data and disclosing terms replaced in the text. Texts are shuffled once, to meet their spans."""
    spans = sanitise_spans(docs, settings, text, keys).filter("spans != ''").select("row", F.col("spans").alias("_spans")).distinct()
    spans = freeze(spans, "spans")
    names = docs.columns
    row = docs.withColumn("_row", F.xxhash64(*[F.col(f"`{k}`") for k in keys], F.col(f"`{text}`")))
    met = row.join(sized(spans.withColumnRenamed("row", "_of")), F.col("_row") == F.col("_of"), "left")
    source = met.select(*[F.col(f"`{c}`") for c in names if c != text], F.col(f"`{text}`").cast("string").alias("_text"), "_spans")
    schema = source.drop("_text", "_spans").schema.add("_clean", "string")
    clean = source.mapInArrow(_cleaner, schema)
    return clean.select(*[F.col("_clean").alias(text) if c == text else F.col(f"`{c}`") for c in names])


@query("op4_private_terms")
def op4_private_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = sanitise_spans(docs)
    return found.select("doc_id", *[f"n_{k}" for k in KINDS], F.sha2(F.col("base"), 256).alias("base_sha256"), "spans")
