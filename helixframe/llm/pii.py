"""Personal data: fixed patterns, extended by bootstrapped contextual extraction.

Base entities (email, ip, card, phone) and long hexadecimal keys are the seeds. The words in front of a seed induce
lexical patterns; patterns and the identifier-like tokens they precede form a bipartite graph that Spark scores in a few
rounds: a pattern is as trustworthy as the instances it precedes, an unknown instance as its patterns. Patterns
that end with high confidence mark identifiers no base rule knows, as spans of the kind of their seeds.

Edge cases: null text is empty; repeated rows are each reported; an empty table gives an empty result; ties
between kinds go to the kind listed first. Positions count code points, ends are exclusive.
"""
from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.runtime import fits, stage

#: Patterns up to which they are told to all tasks; beyond it spans are joined to the texts.
PATTERNS = 100_000
KINDS = ["email", "ip", "card", "phone", "secret"]
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match starts at the first digit of a run: a later start in the run could not match where the first does not
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")
_NO_DIGIT = re.compile(r"[^0-9]")
_KEY = re.compile(r"(?=[0-9a-fA-F]*[a-fA-F])(?=[0-9a-fA-F]*[0-9])[0-9a-fA-F]{32,}")
_STOP = frozenset(" \t\n\r\x0b\x0c\"'`<>(){}[],;")


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches found from their at signs, so that long runs without one cost nothing."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL_END.match(text[start - 1]):
            start -= 1
        hit = _DOMAIN.match(text, at + 1) if start < at else None
        if hit:
            yield start, hit.end()
            done = hit.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", done)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the base kinds, in the order of the kinds, then of their starts."""
    found = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if "." in text:
        found += [("ip", *m.span()) for m in _IP.finditer(text)
                  if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        digits = _NO_DIGIT.sub("", m.group()) if m.end() - m.start() <= 40 else ""
        if 16 <= len(digits) <= 19 and _luhn(digits):
            found.append(("card", *m.span()))
    if "+" in text:
        found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_NO_DIGIT.sub("", m.group())) <= 15]
    return found


def _context(text: str, start: int, words: int) -> str:
    """The last ``words`` words in front of ``start`` on its line, with the punctuation that touches it."""
    line = text[max(text.rfind("\n", 0, start) + 1, start - 100):start]
    return " ".join(line.split(" ")[-words - 1:]).lstrip()


def candidates(text: str, base: list[tuple[str, int, int]], words: int = 2, shortest: int = 6) -> list[tuple]:
    """(start, end, context, instance, kind or None) of the seeds and of other tokens that hold a digit."""
    rows = [(a, b, _context(text, a, words), text[a:b], kind) for kind, a, b in base]
    spans, k, done = sorted((a, b) for _, a, b in base), 0, 0
    for m in _DIGITS.finditer(text):
        if m.start() < done:
            continue
        a, b = m.span()
        while a > done and text[a - 1] not in _STOP:
            a -= 1
        while b < len(text) and text[b] not in _STOP:
            b += 1
        done = b
        while b > a and text[b - 1] in ".:!?":
            b -= 1
        while k < len(spans) and spans[k][1] <= a:
            k += 1
        if b - a < shortest or k < len(spans) and spans[k][0] < b:
            continue
        token = text[a:b]
        rows.append((a, b, _context(text, a, words), token, "secret" if _KEY.fullmatch(token) else None))
    return rows


def _seen_in(text: str) -> tuple[list[tuple], list[tuple]]:
    """Base spans, and (start, end, context, digest of the instance, kind or None) of all candidates with a context."""
    base = base_spans(text)
    return base, [(a, b, c.lower(), hashlib.sha1(t.encode("utf-8", "replace")).hexdigest()[:16], kind)
                  for a, b, c, t, kind in candidates(text, base) if c]


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for doc_id, key, text in zip(batch["doc_id"], batch["key"], batch["text"]):
            base, more = _seen_in(text)
            out.append((doc_id, key, base, more))
        frame = pd.DataFrame(out, columns=["doc_id", "key", "base", "more"])
        yield frame.astype({"doc_id": "Int64"})


_SCANNED = ("doc_id long, key long, base array<struct<kind:string,a:int,b:int>>, "
            "more array<struct<a:int,b:int,context:string,instance:string,kind:string>>")


def _scanned(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("key"),
                       F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInPandas(_scan, _SCANNED)


def trusted_patterns(found: DataFrame, rounds: int = 3, support: int = 3, confidence: float = 0.8) -> DataFrame:
    """context, kind: lexical patterns that end with at least ``confidence``.

    ``found`` has context, instance and kind (null: unknown). ``support`` distinct seeds of the kind are needed.
    """
    edges = stage(found.groupBy("context", "instance").agg(F.min("kind").alias("kind")), "pii-edges")
    kinds = edges.where("kind is not null").groupBy("context", "kind").agg(F.count("*").alias("seeds")) \
                 .where(F.col("seeds") >= support)
    sizes = edges.groupBy("context").agg(F.count("*").alias("size"))
    patterns = stage(kinds.join(sizes, "context").withColumn("score", F.col("seeds") / F.col("size")), "pii-patterns")
    unknown = edges.where("kind is null").select("context", "instance")
    for _ in range(rounds):
        belief = (unknown.join(patterns.select("context", "kind", "score"), "context")
                  .groupBy("instance", "kind").agg((1 - F.exp(F.sum(F.log(1.000001 - F.col("score"))))).alias("belief")))
        gained = (unknown.join(belief, "instance").groupBy("context", "kind").agg(F.sum("belief").alias("gain")))
        # an unknown instance counts for its pattern by half of its belief, so that patterns without enough seeds stay low
        patterns = stage(patterns.drop("score").join(gained, ["context", "kind"], "left").withColumn(
            "score", (F.col("seeds") + 0.5 * F.coalesce("gain", F.lit(0.0))) / F.col("size")).drop("gain"), "pii-patterns")
    best = patterns.where(F.col("score") >= confidence).groupBy("context").agg(
        F.max_by("kind", F.struct("score", F.when(F.lit(True), -F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))))).alias("pattern_kind"))
    return best


def _with_spans(scanned: DataFrame, patterns: DataFrame | None = None) -> DataFrame:
    """doc_id, key, base and extra (spans the method adds), one row per row of ``scanned``."""
    found = scanned.select("key", F.explode("more").alias("m")).select("key", "m.*")
    if patterns is None:
        patterns = trusted_patterns(found.select("context", "instance", "kind"))
    added = found.where("kind is null or kind = 'secret'").join(patterns, "context", "left").select(
        "key", F.struct(F.coalesce("kind", "pattern_kind").alias("kind"), "a", "b").alias("s")).where("s.kind is not null")
    extra = added.groupBy("key").agg(F.collect_set("s").alias("extra"))
    return scanned.select("doc_id", "key", "base").join(extra, "key", "left")


def _listed(spans):
    order = F.array(*map(F.lit, KINDS))
    ranked = F.sort_array(F.transform(spans, lambda s: F.struct(
        F.array_position(order, s["kind"]).alias("k"), s["a"].alias("a"), s["b"].alias("b"), s["kind"].alias("kind"))))
    return F.array_join(F.transform(ranked, lambda s: F.concat_ws(":", s["kind"], s["a"].cast("string"), s["b"].cast("string"))), ",")


def find_pii(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: counts of the base kinds, digest of the base spans, and all spans."""
    rows = _with_spans(stage(_scanned(docs), "pii-scanned"))
    none = F.array().cast("array<struct<kind:string,a:int,b:int>>")
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return rows.select("doc_id", *map(count, KINDS[:4]), F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
                       _listed(F.concat("base", F.coalesce("extra", none))).alias("spans"))


def _without(text: str, spans: list[tuple[int, int, str]]) -> str:
    """``text`` with its spans (start, end, kind) replaced."""
    parts, done = [], 0
    for a, b, kind in sorted(spans):
        if a >= done:
            parts += [text[done:a], f"<{kind.upper()}>"]
        done = max(done, b)
    return "".join([*parts, text[done:]])


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = [_without(text, [(s["a"], s["b"], s["kind"]) for s in spans]) if text and spans is not None and len(spans) else text
                 for text, spans in zip(batch["text"], batch["spans"])]
        yield batch.drop(columns=["spans", "text"]).assign(text=texts)


def redact_pii(docs: DataFrame) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind in angle brackets; other columns as they were.

    ``n_chars``, where there is one, is counted anew. Texts without a span are passed as they are. Texts are read twice, for
    the patterns and to be cut where they are: they are not shuffled, unless there are more patterns than PATTERNS.
    """
    patterns = stage(trusted_patterns(_found(docs)), "pii-trusted")
    both = _cut_in_place(docs, patterns) if fits(patterns, PATTERNS) else _cut_by_join(docs, patterns)
    if "n_chars" in docs.columns:
        both = both.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return both


def _found(docs: DataFrame) -> DataFrame:
    """context, instance, kind of all candidates."""
    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([x[2:] for text in batch["text"] for x in _seen_in(text)[1]], columns=["context", "instance", "kind"])

    return docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInPandas(find, "context string, instance string, kind string")


def _cut_in_place(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    table = docs.sparkSession.sparkContext.broadcast({r["context"]: r["pattern_kind"] for r in patterns.collect()})  # at most PATTERNS rows
    at = docs.columns.index("text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text in batch.column(at).to_pylist():
                if text:
                    base, more = _seen_in(text)
                    spans = [(a, b, kind) for kind, a, b in base]
                    spans += [(a, b, kind or table.value[c]) for a, b, c, _, kind in more if kind == "secret" or kind is None and c in table.value]
                    text = _without(text, spans) if spans else text
                texts.append(text)
            columns = batch.columns
            columns[at] = pa.array(texts, type=columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    named = docs.toDF(*[f"_c{k}" for k in range(len(docs.columns))])  # names that clash with nothing
    return named.mapInArrow(cut, named.schema).toDF(*docs.columns)


def _cut_by_join(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    rows = _with_spans(stage(_scanned(docs), "pii-scanned"), patterns)
    none = F.array().cast("array<struct<kind:string,a:int,b:int>>")
    spans = (rows.select("key", F.concat("base", F.coalesce("extra", none)).alias("spans")).where(F.size("spans") > 0)
             .dropDuplicates(["key"]))
    own = [f"_c{k}" for k in range(len(docs.columns))]  # names that clash with nothing
    named = docs.toDF(*own)
    text = own[docs.columns.index("text")]
    keyed = named.withColumn("key", F.xxhash64(own[docs.columns.index("doc_id")], text)).join(spans, "key", "left")
    pick = [F.col(c) for c in own]
    cut = keyed.select("key", *[c for c in own if c != text], F.col(text).alias("text"), "spans")
    plain = cut.where("spans is null").select(*[F.col("text").alias(text) if c == text else F.col(c) for c in own])
    schema = ", ".join(["key long", *[f"{f.name} {f.dataType.simpleString()}" for f in named.schema if f.name != text], "text string"])
    done = cut.where("spans is not null").mapInPandas(_cut, schema).withColumnRenamed("text", text).select(*pick)
    return plain.unionByName(done).toDF(*docs.columns)
