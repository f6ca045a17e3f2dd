"""Information-theoretic sanitisation: personal data and the words that give it away.

*Base*: four kinds of personal data by fixed patterns. *Method*: every distinct
match is a protected entity. Words within ``window`` words of it on its line are
its context. Over the whole corpus, the pointwise mutual information of an entity
and a word, as a share of the entity's own information, is the word's
disclosure: 1 if the word occurs nowhere but beside the entity, near 0 if it is as
frequent elsewhere. Context words from ``generalise_from`` on are replaced by their
class, from ``remove_from`` on they are removed, if entity and word met ``min_support`` times.

All counts cover all documents. Only a word that stands beside an entity is counted
(a bitmap of fixed size picks these out), and only numbers leave a task.

Nulls and edges: a null text is empty; a null id stays null; repeated rows are judged one by
one, and count as often as they occur; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm import tokens
from shelfwise.llm.common import in_bitmap, map_arrow, materialise, membership_bitmap, row_key

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
#: Rows that a task hands back at once.
OUT_ROWS = 2_000
#: Characters in which a context word must lie, times the words of a window.
WORD_REACH = 60
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_WORD = re.compile(r"[0-9A-Za-z\x80-\U0010ffff]+")
_NOT_DIGIT = re.compile(r"[^0-9]")
_SPAN = "array<struct<kind:string,start:int,end:int>>"
_NEAR = "array<struct<entity:long,term:long,start:int,end:int>>"


@dataclass(frozen=True)
class Sanitiser:
    window: int = 5
    min_support: int = 3
    generalise_from: float = 0.75
    remove_from: float = 0.95


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the email pattern, found from the domain back, in linear time.

    No @ can be in a local part, so each match starts where the characters
    before its @ stop fitting, or where the last match ended.
    """
    free = 0
    for domain in _DOMAIN.finditer(text):
        at = domain.start()
        start = at
        while start > free and _is_local(text[start - 1]):
            start -= 1
        if start < at:
            yield start, domain.end()
            free = domain.end()


def _is_local(c: str) -> bool:
    return c.isascii() and (c.isalnum() or c in "._%+-")


def ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p) <= 255 for p in (g.lstrip("0") or "0" for g in m.groups())):
            yield m.span()


def passes_luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        if 16 <= len(digits) <= 19 and passes_luhn(digits):
            yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
            yield m.span()


FINDERS: dict[str, Callable[[str], Iterator[tuple[int, int]]]] = {"email": emails, "ip": ips, "card": cards, "phone": phones}


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as in ``KINDS``, then start; code points, end exclusive."""
    return [(kind, start, end) for kind, find in FINDERS.items() for start, end in find(text)]


def entity_key(kind: str, value: str) -> int:
    """Hash of a protected entity: e-mail addresses in lower case, numbers by their digits."""
    plain = value.lower() if kind == "email" else value if kind == "ip" else _NOT_DIGIT.sub("", value)
    return tokens.hash_word(f"{kind}:{plain}", tokens.SPACED)


def merged(spans: list[tuple[str, int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the spans' union, in order."""
    starts: list[int] = []
    ends: list[int] = []
    for start, end in sorted((s, e) for _, s, e in spans):
        if ends and start <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    return starts, ends


def context(text: str, spans: list[tuple[str, int, int]], window: int) -> list[tuple[int, int, int, int]]:
    """(entity, term, start, end) of the words near each span, on its line and outside all spans.

    A window ends at WORD_REACH characters a word, and at a word cut off there.
    """
    starts, ends = merged(spans)
    out: list[tuple[int, int, int, int]] = []
    for kind, start, end in spans:
        entity = entity_key(kind, text[start:end])
        low = max(0, start - WORD_REACH * window)
        low = max(low, text.rfind("\n", low, start) + 1)
        high = min(len(text), end + WORD_REACH * window)
        stop = text.find("\n", end, high)
        high = high if stop < 0 else stop
        words = [m.span() for m in _WORD.finditer(text, low, start)][-window:]
        words += [m.span() for m in _WORD.finditer(text, end, high)][:window]
        for a, b in words:
            k = bisect_right(starts, b - 1) - 1
            whole = (a == 0 or not _WORD.match(text[a - 1])) and (b == len(text) or not _WORD.match(text[b]))
            if whole and (k < 0 or ends[k] <= a):
                out.append((entity, tokens.hash_word(text[a:b]), a, b))
    return out


def entities(docs: DataFrame, cfg: Sanitiser, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(rid, doc_id, row, base, named, near) of every row: spans, their entities and context, without the text.

    ``rid`` tells rows apart; it holds once the result is written.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span_type, near_type = _arrow_type(_SPAN), _arrow_type(_NEAR)
        for batch in batches:
            for first in range(0, batch.num_rows, OUT_ROWS):
                part = batch.slice(first, OUT_ROWS)
                texts = [t or "" for t in part.column("_text").to_pylist()]
                spans = [base_spans(t) for t in texts]
                near = [context(t, s, cfg.window) if s else [] for t, s in zip(texts, spans)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("row"),
                        pa.array([[dict(zip(("kind", "start", "end"), s)) for s in x] for x in spans], span_type),
                        pa.array([[entity_key(k, t[a:b]) for k, a, b in x] for t, x in zip(texts, spans)], pa.list_(pa.int64())),
                        pa.array([[dict(zip(("entity", "term", "start", "end"), s)) for s in x] for x in near], near_type),
                    ],
                    names=["doc_id", "row", "base", "named", "near"],
                )

    kind = docs.schema[doc_id].dataType.simpleString()
    source = docs.select(F.col(doc_id).alias("doc_id"), row_key(F.col(doc_id), F.col(text)).alias("row"), F.col(text).alias("_text"))
    found = map_arrow(source, work, f"doc_id {kind}, row long, base {_SPAN}, named array<long>, near {_NEAR}")
    return found.withColumn("rid", F.monotonically_increasing_id())


def _arrow_type(spark_type: str) -> pa.DataType:
    fields = re.findall(r"(\w+):(\w+)", spark_type)
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}
    return pa.list_(pa.struct([(name, kinds[kind]) for name, kind in fields]))


def word_counts(docs: DataFrame, wanted: DataFrame, text: str = "text") -> tuple[DataFrame, int]:
    """(term, n) over all documents of at least the ``wanted`` terms, and the number of all words."""
    bitmap = docs.sparkSession.sparkContext.broadcast(membership_bitmap(wanted, "term"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, terms, n = 0, np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            for chunk in tokens.chunks(batch.column(0)):
                hashes = tokens.words(chunk.data, chunk.bounds, tokens.ALNUM).hash.view(np.int64)
                total += len(hashes)
                found, times = np.unique(hashes[in_bitmap(bitmap.value, hashes)], return_counts=True)
                terms, place = np.unique(np.concatenate((terms, found)), return_inverse=True)
                n = np.bincount(place, np.concatenate((n, times)), len(terms)).astype(np.int64)
        # One row a term and task, however many chunks hold it.
        yield pa.RecordBatch.from_arrays([pa.array(terms), pa.array(n)], names=["term", "n"])
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([total], pa.int64())], names=["term", "n"])

    counts = materialise(map_arrow(docs.select(text), work, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")), "pii-words")
    total = counts.where("term is null").agg(F.sum("n")).first()[0] or 0
    return counts.where("term is not null"), int(total)


def disclosures(found: DataFrame, docs: DataFrame, cfg: Sanitiser, text: str = "text") -> DataFrame:
    """(entity, term, disclosure) of the pairs that exceed ``generalise_from``."""
    near = found.select(F.explode("near").alias("x")).select("x.entity", "x.term")
    pairs = materialise(near.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("together")).where(F.col("together") >= cfg.min_support), "pii-pairs")
    words, total = word_counts(docs, pairs.select("term").distinct(), text)
    named = found.select(F.explode("named").alias("entity")).groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"))
    sizes = materialise(named.where(F.col("n_entity") >= cfg.min_support), "pii-entities")
    joined = pairs.join(words, "term").join(sizes, "entity")
    own = F.log(F.lit(float(max(total, 1))) / F.col("n_entity"))
    shared = F.log(F.col("together") * F.lit(float(max(total, 1))) / (F.col("n_entity") * F.col("n")))
    return joined.select("entity", "term", F.least(shared / own, F.lit(1.0)).alias("disclosure")).where(
        (own > 0) & (F.col("disclosure") >= cfg.generalise_from)
    )


def find(docs: DataFrame, cfg: Sanitiser | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, row, base, terms) of every row: base spans, and term spans with their disclosure.

    ``row`` is ``common.row_key``, to join back to ``docs``. Only context words of flagged pairs are
    shuffled, and a pair that many documents share meets its verdict in a join of plain scans.
    """
    cfg = cfg or Sanitiser()
    found = materialise(entities(docs, cfg, doc_id, text), "pii-found")
    flagged = materialise(disclosures(found, docs, cfg, text), "pii-disclosures")
    near = found.select("rid", F.explode("near").alias("x")).select("rid", "x.entity", "x.term", "x.start", "x.end")
    hits = near.join(flagged, ["entity", "term"]).groupBy("rid", "start", "end").agg(F.max("disclosure").alias("disclosure"))
    terms = hits.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("start", "end", "disclosure"))).alias("terms"))
    none = F.array().cast("array<struct<start:int,end:int,disclosure:double>>")
    return found.join(terms, "rid", "left").select("doc_id", "row", "base", F.coalesce("terms", none).alias("terms"))


def sanitise(docs: DataFrame, cfg: Sanitiser | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``text`` sanitised: entities become [KIND], terms [WORD] or [NUMBER], or go."""
    cfg = cfg or Sanitiser()
    found = materialise(find(docs, cfg, doc_id, text).dropDuplicates(["doc_id", "row"]), "pii-spans")
    found = found.where("size(base) > 0").select(F.col("doc_id").alias("_id"), F.col("row").alias("_row0"), "base", "terms")
    keyed = docs.withColumn("_row", row_key(F.col(doc_id), F.col(text)))
    joined = keyed.join(found, (F.col("_row") == F.col("_row0")) & F.col(doc_id).eqNullSafe(F.col("_id")), "left")

    @F.udf(T.StringType(), useArrow=True)
    def rewritten(body: str | None, base: list | None, terms: list | None) -> str | None:
        if not base or body is None:
            return body
        cuts = [(s["start"], s["end"], f"[{s['kind'].upper()}]") for s in base]
        for t in terms or []:
            word = body[t["start"] : t["end"]]
            kind = "[NUMBER]" if word.isdigit() else "[WORD]"
            cuts.append((t["start"], t["end"], "" if t["disclosure"] >= cfg.remove_from else kind))
        out, at = [], 0
        for start, end, new in sorted(cuts):
            if start >= at:
                out += [body[at:start], new]
            at = max(at, end)
        return "".join(out) + body[at:]

    return joined.withColumn(text, rewritten(F.col(text), F.col("base"), F.col("terms"))).drop("_row", "_row0", "_id", "base", "terms")
