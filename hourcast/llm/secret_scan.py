"""Secret scan with corpus-wide ownership frequency.

Each whole text is scanned for base kinds (assignments, access keys, long hex runs) and for generic mixed
tokens. Every candidate's value is hashed, and over the whole corpus each value is counted by distinct documents
(repositories) and distinct owners. A value is a copied example if ``MIN_OWNERS`` owners have it, or if two have it in
``MIN_COPIES`` documents or more: between two owners the documents tell a leak that was forked or quoted from an example
that is pasted widely. A single owner's value stays that owner's in however many documents (a key on every page of a site).
Values that are no example and look live (long, high entropy, little of them placeholder words) are live credentials; the
rest is unclear. Generic tokens become spans only when they are live; base spans always stay, and examples are not redacted.

Values are counted per (value, owner) before owners are counted, so a value in a third of all documents is
summed within tasks first. Values themselves never leave a task; 64-bit hashes do.

Spans are ``kind:start:end`` in code points, end exclusive, of the whole match, by start and then by kind in the
order of ``KINDS``. Base matches are leftmost and non-overlapping within a kind; generic tokens don't overlap
base spans.

Defined cases: a null text is an empty one, without spans. A null owner is an owner of its own. Repeated rows
(same id and text) are one document for the counts and each gets its own result. Further columns are ignored
by ``scan`` and kept by ``redact``, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourcast.llm.keyfilter import maybe_in
from hourcast.llm.textbatch import free_name, give_back, row_key
from hourcast.session import cut_lineage

# Kinds in order, and the base patterns of the contract.
KINDS = ("assign", "access", "hex", "generic")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # the maximal runs of 24 or more
_KEYWORDS = ("passw", "secret", "token", "api")
_GENERIC = re.compile(r"(?<![A-Za-z0-9_+/=-])[A-Za-z0-9_+/=-]{20,}(?![A-Za-z0-9_+/=-])")
_PLACEHOLDER = re.compile(r"example|sample|placeholder|change_?me|your|dummy|test|xxxx|1234567|abcdef|deadbeef", re.I)

MIN_ENTROPY = 3.0  # bits a character
MIN_LIVE = 16  # characters
PLACEHOLDER_PART = 1 / 16  # of a value's characters under placeholder words makes it one; thousands hold one by chance
MIN_OWNERS = 3  # owners that make a value a copied example
MIN_COPIES = 10  # documents that make a value of two owners one
MARK = "[SECRET]"


def entropy(value: str) -> float:
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def looks_live(value: str) -> bool:
    if len(value) < MIN_LIVE or entropy(value) < MIN_ENTROPY:
        return False
    return sum(m.end() - m.start() for m in _PLACEHOLDER.finditer(value)) < PLACEHOLDER_PART * len(value)


def candidates(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, value) of all candidates of a text, sorted."""
    out = []
    low = text.lower()
    if any(k in low for k in _KEYWORDS):
        out += [(m.start(), 0, m.end(), m.group(2)) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m.group()) for m in _ACCESS.finditer(text) if len(m.group()) >= 20]
    out += [(m.start(), 2, m.end(), m.group()) for m in _HEX.finditer(text)]
    base = sorted((s, e) for s, _, e, _ in out)
    for m in _GENERIC.finditer(text):
        value = m.group()
        if any(c.isdigit() for c in value) and any(c.isalpha() for c in value) and looks_live(value):
            if not any(s < m.end() and m.start() < e for s, e in base):
                out.append((m.start(), 3, m.end(), value))
    return sorted(out)


_SPAN = "struct<kind:int,start:int,end:int,value:bigint,live:boolean>"


def scan(docs: DataFrame, owner: str = "source") -> DataFrame:
    """doc_id, row_key, owner and candidate spans of every row."""

    def run(batches):
        for batch in batches:
            spans = [[{"kind": k, "start": s, "end": e, "value": xxhash.xxh64_intdigest(v) - (1 << 63), "live": looks_live(v)}
                      for s, k, e, v in candidates(t or "")] for t in batch.column("text").to_pylist()]
            kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.int64()), ("live", pa.bool_())]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row_key"), batch.column("owner"), pa.array(spans, kind)],
                                             names=["doc_id", "row_key", "owner", "spans"])
            give_back()

    rows = docs.select("doc_id", "text", row_key().alias("row_key"), F.col(owner).cast("string").alias("owner"))
    return rows.mapInArrow(run, f"doc_id bigint, row_key bigint, owner string, spans array<{_SPAN}>")


def ownership(found: DataFrame, min_owners: int = MIN_OWNERS, min_copies: int = MIN_COPIES) -> DataFrame:
    """value, n_documents, n_owners and status (example, live, unclear) of every candidate value."""
    rows = found.select("doc_id", "row_key", "owner", F.explode(F.array_distinct(F.transform(
        "spans", lambda s: F.struct(s["value"].alias("value"), s["live"].alias("live"))))).alias("v"))
    by_owner = (rows.groupBy("v.value", "owner", "doc_id", "row_key").agg(F.max("v.live").alias("live"))
                .groupBy("value", "owner").agg(F.count(F.lit(1)).alias("n"), F.max("live").alias("live")))
    copied = (F.col("n_owners") >= min_owners) | ((F.col("n_owners") > 1) & (F.col("n_documents") >= min_copies))
    return (by_owner.groupBy("value").agg(F.sum("n").alias("n_documents"), F.count(F.lit(1)).alias("n_owners"), F.max("live").alias("live"))
            .withColumn("status", F.when(copied, "example").when(F.col("live"), "live").otherwise("unclear")))


def judged(docs: DataFrame, owner: str = "source", min_owners: int = MIN_OWNERS) -> DataFrame:
    """doc_id, row_key, spans with a status, one row for each distinct (doc_id, row_key) that has candidates."""
    found = cut_lineage(scan(docs, owner).where(F.size("spans") > 0))  # few rows beside the texts, read twice
    status = ownership(found, min_owners).select("value", "status")
    one = found.groupBy("doc_id", "row_key").agg(F.first("spans").alias("spans"))
    rows = one.select("doc_id", "row_key", F.explode("spans").alias("s")).withColumn("value", F.col("s.value"))
    span = F.struct(F.col("s.start").alias("start"), F.col("s.kind").alias("kind"), F.col("s.end").alias("end"), F.col("status"))
    return (rows.join(status, "value").where((F.col("s.kind") < 3) | (F.col("status") == "live"))
            .groupBy("doc_id", "row_key").agg(F.sort_array(F.collect_list(span)).alias("spans")))


def _same(a: str, b: str):
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.row_key") == F.col(f"{b}.row_key"))


def report(docs: DataFrame) -> DataFrame:
    keys, got = docs.select("doc_id", row_key().alias("row_key")).alias("k"), judged(docs).alias("j")
    name = F.array(*[F.lit(k) for k in KINDS])
    text = lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"], s["end"])
    joined = lambda spans: F.array_join(F.transform(spans, text), ",")
    spans = F.coalesce(F.col("j.spans"), F.array().cast("array<struct<start:int,kind:int,end:int,status:string>>"))
    rows = keys.join(got, _same("k", "j"), "left").select("k.doc_id", spans.alias("all"))
    base = F.filter("all", lambda s: s["kind"] < 3)
    number = lambda k: F.size(F.filter("all", lambda s: s["kind"] == k)).cast("bigint")
    status = lambda v: F.size(F.filter("all", lambda s: s["status"] == v)).cast("bigint")
    return rows.select("doc_id", number(0).alias("n_assign"), number(1).alias("n_access"), number(2).alias("n_hex"),
                       F.sha2(joined(base), 256).alias("base_sha256"), joined("all").alias("spans"),
                       status("live").alias("n_live"), status("example").alias("n_example"))


def redact(docs: DataFrame, owner: str = "source", min_owners: int = MIN_OWNERS, mark: str = MARK) -> DataFrame:
    """``docs`` with every found secret but the copied examples replaced by ``mark``; all rows and columns stay."""
    cut_name, key_name = free_name(docs, "cut"), free_name(docs, "row_key")
    cut = (judged(docs, owner, min_owners)
           .select("doc_id", "row_key", F.transform(F.filter("spans", lambda s: s["status"] != "example"),
                                                    lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias(cut_name)))
    cut = cut_lineage(cut.where(F.size(cut_name) > 0))
    maybe = maybe_in(cut, "doc_id", "row_key")
    docs_keyed = docs.withColumn(key_name, row_key())
    d, c = docs_keyed.where(maybe("doc_id", key_name)).alias("d"), cut.alias("c")
    on = F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col(f"d.{key_name}") == F.col("c.row_key"))
    rows = d.join(c, on, "left").select(*[F.col(f"d.`{x}`") for x in docs.columns], f"c.{cut_name}")

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index("text")
            cuts = batch.column(cut_name).to_pylist()
            batch = batch.drop_columns([cut_name])
            if any(cuts):
                texts = batch.column("text").to_pylist()
                for i, spans in enumerate(cuts):
                    if spans:
                        keep, last = [], 0
                        for s in spans:
                            if s["start"] >= last:
                                keep += [texts[i][last:s["start"]], mark]
                            last = max(last, s["end"])
                        texts[i] = "".join([*keep, texts[i][last:]])
                batch = batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
            yield batch
            give_back()

    rest = docs_keyed.where(~maybe("doc_id", key_name)).drop(key_name)
    return rest.unionByName(rows.mapInArrow(run, docs.schema))
