"""Personal data: patterns, and terms that give away what the patterns hide."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.keyjoin import join_right
from ..session import written
from .common import Batches, slices, tidy

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
# A term gives an entity away if, as far as its documents show, it carries this
# share of the entity's information, and the entity is in this part of the
# documents with the term, whatever the size of the corpus. From REMOVE on it goes.
GENERALISE, CERTAIN, REMOVE = 0.8, 0.5, 0.8
# Standard deviations by which what is counted may be too high.
CONFIDENCE = 1.0
# Letters that stay of a generalised term.
STEM = 2
HELD = 200_000
# Rare terms of one text that a task pairs with the text's entities.
HOT_TERMS = 50_000

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match cannot start inside a run of digits: one from the run's start is longer.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_EDGES = ".,;:!?\"'()[]{}<>"


def _luhn(digits: str) -> bool:
    total = 0
    for n, d in enumerate(reversed(digits)):
        d = int(d) * (1 + n % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each @ to the left over the local part, not past the last match; linear in any text."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            end = domain.end()
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind, then start; code points, end exclusive."""
    found = [("email", *s) for s in _emails(text)]
    if "." in text:
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and _luhn(digits):
                found.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append(("phone", *m.span()))
    return found


def _hash(text: str) -> int:
    """Signed 64-bit hash."""
    value = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))
    return value - (1 << 64) if value >> 63 else value


def term_of(word: str) -> str:
    """A word in the form it is counted in; empty if it says nothing by itself."""
    word = word.strip(_EDGES).lower()
    return word if len(word) >= 3 and any(c.isalpha() for c in word) else ""


def _held(text: str, spans: list[tuple[str, int, int]]) -> tuple[set[int], set[int]]:
    """The entities of a text, and the terms of its words outside all spans."""
    entities = {_hash(f"{kind}:{''.join(c for c in text[s:e].lower() if c.isalnum() or c in '@.')}") for kind, s, e in spans}
    taken, n, words = sorted((s, e) for _, s, e in spans), 0, set()
    for m in _WORD.finditer(text):
        while n < len(taken) and taken[n][1] <= m.start():
            n += 1
        if n == len(taken) or taken[n][0] >= m.end():
            words.add(m[0])
    terms = {term_of(word) for word in words} - {""}
    return entities, {_hash(term) for term in terms}


@tidy
def _evidence(batches: Batches) -> Batches:
    """(doc, key, is_term) of the entities and terms of the texts that hold an entity."""
    for batch in batches:
        for doc, value in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = value.as_py()
            if text and (spans := base_spans(text)):
                entities, terms = _held(text, spans)
                keys = [*entities, *terms]
                arrays = [pa.array([doc] * len(keys), pa.int64()), pa.array(keys, pa.int64())]
                flags = pa.array([False] * len(entities) + [True] * len(terms))
                yield pa.RecordBatch.from_arrays([*arrays, flags], names=["doc", "key", "is_term"])


@tidy
def _terms(batches: Batches) -> Batches:
    """(term, n): in how many of the task's texts a term is, as partial counts of a bounded table."""
    counts: Counter = Counter()
    hashes: dict[str, str] = {}

    def out() -> pa.RecordBatch:
        n = pa.array(list(counts.values()), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array([_hash(t) for t in counts], pa.int64()), n], names=["term", "n"])

    for batch in batches:
        for value in batch.column(0):
            if text := value.as_py():
                terms = set()
                for word in set(text.split()):
                    term = hashes.get(word)
                    if term is None:
                        if len(hashes) > HELD:
                            hashes.clear()
                        term = hashes[word] = term_of(word)
                    terms.add(term)
                terms.discard("")
                counts.update(terms)
        if len(counts) > HELD:
            yield out()
            counts.clear()
    yield out()


def lower_bound(part: Column, of: Column) -> Column:
    """Wilson's lower bound of a share, CONFIDENCE deviations below what was counted."""
    p, z = part / of, CONFIDENCE * CONFIDENCE
    spread = CONFIDENCE * F.sqrt(p * (1 - p) / of + z / (4 * of * of))
    # Whole numbers decide at the edge, not how the root is rounded.
    return F.round((p + z / (2 * of) - spread) / (1 + z / of), 12)


def disclosures(docs: DataFrame) -> DataFrame:
    """content, terms: per text the terms in it that give away an entity of it, as (hash, whether to remove).

    With N documents, n of them with the entity, m with the term and b with
    both, wherever they stand, p is the lower confidence bound (Wilson's) of
    b / m. The term gives log(p N / n), its mutual information with the entity,
    of the entity's log(N / n): it is marked from the share GENERALISE on, and
    never where p is under CERTAIN. So a term of one document with an entity is
    marked only if no other document has it, in a corpus of any size. All
    documents are counted, whole; a text's content is its hash.

    Entities of the same texts are judged as one. A pair is made only where
    min(n, documents with an entity and the term), which b cannot exceed,
    would be enough, so common words meet no entity. A text with many of both
    is split over tasks by its terms.
    """
    rows = docs.select(F.xxhash64("text").alias("content"), "text")
    seen = written(rows.mapInArrow(_evidence, "doc long, key long, is_term boolean").distinct(), "evidence")
    empty = seen.sparkSession.createDataFrame([], "content long, terms array<struct<term: bigint, gone: boolean>>")
    if seen.isEmpty():
        return empty
    total = docs.count()
    if total < 2:  # nothing to compare with
        return empty
    copies = docs.groupBy(F.xxhash64("text").alias("doc")).agg(F.count(F.lit(1)).alias("rows"))
    weighed = written(seen.join(copies, "doc"), "weighed")
    holders = weighed.where("NOT is_term").groupBy("key").agg(
        F.sum("rows").alias("with_entity"), *[F.bit_xor(F.xxhash64("doc", F.lit(n))).alias(f"set_{n}") for n in (1, 2)]
    )
    holders = holders.where(F.col("with_entity") < total)
    holders = holders.select(F.col("key").alias("__key"), "with_entity", F.xxhash64("set_1", "set_2").alias("entity"))
    own = join_right(weighed.where("NOT is_term").select("doc", "key", "rows"), ["key"], holders, ["__key"], "inner")
    own = own.select("doc", "rows", "entity", "with_entity").distinct()

    def enough(both: Column, with_entity: Column) -> Column:
        low = lower_bound(both, F.col("with_term"))
        information = 1 - F.log(low) / F.log(with_entity / F.lit(float(total)))
        return (low >= CERTAIN) & (information >= GENERALISE)

    held = weighed.where("is_term").groupBy(F.col("key").alias("__term")).agg(F.sum("rows").alias("beside"))
    held = written(held, "held")
    counts = docs.select("text").mapInArrow(_terms, "term long, n long").groupBy("term").agg(F.sum("n").alias("with_term"))
    rare = join_right(counts, ["term"], held, ["__term"], "inner", hot_rows=None)
    # The share of an entity of one document is the least strict.
    rare = written(rare.where(enough(F.col("beside"), F.lit(1.0))).select(F.col("term").alias("__term"), "with_term", "beside"), "rare")
    terms = weighed.where("is_term").select(F.col("doc").alias("__doc"), F.col("key").alias("term"))
    terms = join_right(terms, ["term"], rare, ["__term"], "inner").drop("__term")
    possible = enough(F.least("with_entity", "beside"), F.col("with_entity"))
    pairs = join_right(terms, ["__doc"], own, ["doc"], "inner", also=possible, hot_rows=HOT_TERMS)
    pairs = written(pairs.select("doc", "rows", "entity", "with_entity", "term", "with_term"), "pairs")
    both = pairs.groupBy("entity", "term").agg(
        F.sum("rows").alias("both"), F.min("with_entity").alias("with_entity"), F.min("with_term").alias("with_term")
    )
    strong = both.where(enough(F.col("both"), F.col("with_entity"))).select(
        F.col("entity").alias("__entity"), F.col("term").alias("__term"),
        (lower_bound(F.col("both"), F.col("with_term")) >= REMOVE).alias("gone"),
    )
    strong = written(strong, "disclosing")
    hits = join_right(pairs.select("doc", "entity", "term"), ["entity", "term"], strong, ["__entity", "__term"], "inner")
    gone = hits.groupBy("doc", "term").agg(F.max("gone").alias("gone"))
    # No more than the different words of one text.
    return written(gone.groupBy(F.col("doc").alias("content")).agg(F.collect_list(F.struct("term", "gone")).alias("terms")), "terms")


def _spans(text: str, terms: dict[int, bool]) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int, bool]]]:
    """Base spans, and term spans with whether they go, which overlap no base span."""
    base = base_spans(text)
    if not terms:
        return base, []
    taken, n, more = sorted((s, e) for _, s, e in base), 0, []
    for m in _WORD.finditer(text):
        while n < len(taken) and taken[n][1] <= m.start():
            n += 1
        if n < len(taken) and taken[n][0] < m.end():
            continue
        term = term_of(m[0])
        key = _hash(term) if term else None
        if key in terms:
            at = m.start() + m[0].lower().find(term) if len(m[0].lower()) == len(m[0]) else m.start()
            end = at + len(term) if len(m[0].lower()) == len(m[0]) else m.end()
            more.append((TERM, at, end, terms[key]))
    return base, more


def _joined(spans: list[tuple]) -> str:
    return ",".join(f"{s[0]}:{s[1]}:{s[2]}" for s in spans)


def _with_terms(docs: DataFrame) -> DataFrame:
    """``__row`` (all columns as one struct) and ``terms`` of its text, null for none."""
    packed = docs.select(F.struct("*").alias("__row")).withColumn("__content", F.xxhash64(F.col("__row.text")))
    found = disclosures(docs.select("text"))
    if found.isEmpty():
        return packed.withColumn("terms", F.lit(None).cast(found.schema["terms"].dataType))
    right = found.select(F.col("content").alias("__of"), "terms")
    return join_right(packed, ["__content"], right, ["__of"], "left")


def find(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    Spans are ``kind:start:end``, by kind as listed (terms last), then start,
    joined by commas. Terms are marked in texts that hold the entity they give
    away; other texts have base spans only. Only doc_id and text are read. A
    null text is empty and has none; repeated rows give repeated results and
    count each; an empty table gives an empty result.
    """

    @tidy
    def run(batches: Batches) -> Batches:
        for batch in batches:
            rows = []
            for doc, value, terms in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                base, more = _spans(value.as_py() or "", {t["term"]: t["gone"] for t in terms or ()})
                kinds = Counter(s[0] for s in base)
                text = _joined(base)
                rows.append((doc, *(kinds[k] for k in KINDS), hashlib.sha256(text.encode()).hexdigest(), _joined(base + more)))
            types = [pa.int64()] * 5 + [pa.string()] * 2
            columns = list(zip(*rows)) or [()] * 7
            names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    rows = _with_terms(docs.select("doc_id", "text")).select("__row.doc_id", "__row.text", "terms")
    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return rows.mapInArrow(run, schema)


def cleaned(text: str | None, terms: dict[int, bool]) -> str | None:
    """The text with ``[KIND]`` for its base spans and nothing for removed terms.

    A generalised term becomes the class of all terms that start like it:
    its first STEM letters and a star.
    """
    if not text:
        return text
    base, more = _spans(text, terms)
    out, at = [], 0
    marks = [(s, e, f"[{k.upper()}]") for k, s, e in base]
    marks += [(s, e, "" if gone else f"{text[s : min(e, s + STEM)]}*") for _, s, e, gone in more]
    for start, end, mark in sorted(marks):
        if start < at:  # overlaps another kind: what is left of it goes with that one
            at = max(at, end)
            continue
        out += [text[at:start], mark]
        at = end
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with cleaned texts; n_chars, where it is a column, is counted anew, all others stay.

    Cases as :func:`find`.
    """
    names = docs.columns
    column, counted = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    @tidy
    def clean(batches: Batches) -> Batches:
        for batch in batches:
            for part in slices(batch, column, 256, 1 << 22):
                given, texts, sizes = part.column(len(names)).to_pylist(), [], []
                for value, terms in zip(part.column(column), given):
                    text = value.as_py()
                    texts.append(cleaned(text, {t["term"]: t["gone"] for t in terms or ()}))
                arrays = [part.column(i) for i in range(len(names))]
                arrays[column] = pa.array(texts, pa.string())
                if counted is not None:
                    sizes = zip(texts, arrays[counted].to_pylist())
                    arrays[counted] = pa.array([n if t is None else len(t) for t, n in sizes], arrays[counted].type)
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    last = "terms"
    while last in names:
        last += "_"
    rows = _with_terms(docs).select(*[F.col("__row")[n].alias(n) for n in names], F.col("terms").alias(last))
    return rows.mapInArrow(clean, docs.schema)
