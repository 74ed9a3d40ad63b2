"""Secrets in text, and weak candidates that only count next to a complementary part.

Strong finds (base kinds assign, access, hex) are reported as they are. Weak ones are secret-like strings, identifiers and
endpoints; they are joined with the parts of the other roles within the scope (a run of text without blank lines) and
reported when it holds one, or with a ``reach``, when one lies so near or overlaps. A secret-like value of an identifier is
no complementary part of that identifier.

Defined cases: null text is empty; texts without a find give zero counts and empty spans; repeated rows are reported each;
an empty table gives an empty result; columns of the input named like an output are replaced. Places are code points.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import fresh, row_digest, text_or_empty
from tallymark.session import attach, written

#: Characters between a weak candidate and its complementary part, unless told otherwise; None: the whole scope, as in the query and the pipeline.
REACH = 200

# Fixed patterns of the base kinds.
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "secret", "identifier", "endpoint")

_LONG_HEX = re.compile(r"[0-9a-f]{32,}")
# A run of base64 or base64url characters with its padding; what stands before "=" and more characters is a key, not a value.
_SECRET = re.compile(r"(?<![A-Za-z0-9/+_-])[A-Za-z0-9/+_-]{20,}+(?:={1,2}(?![A-Za-z0-9/+=_-]))?+(?!=)")
_PLAIN = re.compile(r"[A-Za-z0-9/+]{40}")
_CHANGE = re.compile(r"[a-z](?=[A-Z0-9])|[A-Z](?=[a-z0-9])|[0-9](?=[A-Za-z])")
_IDENTIFIER = re.compile(r"""(?ai:access_?key_?id|client_?id|account_?id|user_?name)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]{3,})""")
_ENDPOINT = re.compile(r"(?a:https?|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[A-Za-z0-9._~:/?#\[\]@!$&()*+,;=%-]+")
_BLANK = re.compile(r"\n[ \t\r]*\n")

#: What a weak kind needs nearby.
NEEDS = {"secret": ("access", "identifier", "endpoint"), "identifier": ("assign", "hex", "secret"), "endpoint": ("assign", "secret")}
SPAN = "struct<kind:string,start:bigint,stop:bigint,scope:bigint,own:bigint,touched:boolean>"


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 8]
    out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    return out + [("hex", m.start(), m.end()) for m in _LONG_HEX.finditer(text)]  # a run of 32 or more begins where the run does


def secret_like(run: str) -> bool:
    """Lower case, upper case and digits, changing at every fourth character or more; 40 characters of base64 need no changes."""
    if not (re.search("[a-z]", run) and re.search("[A-Z]", run) and re.search("[0-9]", run)):
        return False
    return bool(_PLAIN.fullmatch(run)) or 4 * len(_CHANGE.findall(run)) >= len(run)


def weak_spans(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Weak candidates that do not touch a strong find; none if the text has no secret-like part at all."""
    found = [("secret", m.start(), m.end()) for m in _SECRET.finditer(text) if secret_like(m[0])]
    if not base and not found:
        return []
    found += [("identifier", m.start(), m.end()) for m in _IDENTIFIER.finditer(text)]
    found += [("endpoint", m.start(), m.end()) for m in _ENDPOINT.finditer(text)]
    taken = sorted((s, e) for _, s, e in base)
    free, i = [], 0
    for kind, s, e in sorted(found, key=lambda x: x[1]):
        while i < len(taken) and taken[i][1] <= s:
            i += 1
        if not any(a < e and s < b for a, b in taken[i : i + 3]):
            free.append((kind, s, e))
    return free


def overlaps(spans: list[tuple[str, int, int]]) -> list[tuple[int, bool]]:
    """For each weak span: how many complementary parts are its own value or own identifier, and whether another one overlaps it."""
    own, touched = [0] * len(spans), [False] * len(spans)
    order = sorted(range(len(spans)), key=lambda i: spans[i][1])
    open_: list[int] = []
    for i in order:
        kind, start, _ = spans[i]
        open_ = [j for j in open_ if spans[j][2] > start]
        for j in open_:
            if spans[j][0] in NEEDS[kind] or kind in NEEDS[spans[j][0]]:
                if "identifier" in (kind, spans[j][0]):
                    own[i] += 1
                    own[j] += 1
                else:
                    touched[i] = touched[j] = True
        open_.append(i)
    return list(zip(own, touched))


def parts(docs: DataFrame, text: str, carry: list[str]) -> DataFrame:
    """``carry``, the digest of the text, strong and weak spans with their scopes."""

    def find(batches):
        for batch in batches:
            strong, weak = [], []
            for t in batch.column("__text").to_pylist():
                base = base_spans(t)
                more = weak_spans(t, base)
                breaks = [m.end() for m in _BLANK.finditer(t)] if more else []
                scoped = []
                for spans, over in ((base, [(0, False)] * len(base)), (more, overlaps(more))):
                    scoped.append([
                        {"kind": k, "start": s, "stop": e, "scope": sum(b <= s for b in breaks) if len(breaks) < 8 else _scope(breaks, s), "own": o, "touched": t}
                        for (k, s, e), (o, t) in zip(spans, over)
                    ])
                strong.append(scoped[0])
                weak.append(scoped[1])
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("scope", pa.int64()), ("own", pa.int64()), ("touched", pa.bool_())]))
            out = {c: batch.column(c) for c in (*carry, "__digest")} | {"strong": pa.array(strong, kind), "weak": pa.array(weak, kind)}
            yield pa.record_batch(list(out.values()), names=list(out))

    df = docs.select(*[F.col(f"`{c}`") for c in carry], F.sha2(text_or_empty(text), 256).alias("__digest"), text_or_empty(text).alias("__text"))
    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name != "__text")
    return df.mapInArrow(find, f"{own}, strong array<{SPAN}>, weak array<{SPAN}>")


def _scope(breaks: list[int], place: int) -> int:
    from bisect import bisect_right

    return bisect_right(breaks, place)


def linked_weak(found: DataFrame, reach: int | None = REACH) -> DataFrame:
    """Weak spans (digest, kind, start, stop) that have a complementary part in their scope, within ``reach`` if that is given.

    For whole scopes the parts of each kind are counted and the counts joined, so that no pairs arise. With a reach it is an
    interval join on bins of ``reach`` characters, from each end of the candidate. Equal texts are joined once.
    """
    texts = found.filter(F.size("weak") > 0)
    weak = texts.select("__digest", F.explode("weak").alias("w")).select("__digest", "w.*").distinct()
    every = texts.select("__digest", F.explode(F.concat("strong", "weak")).alias("p")).select("__digest", "p.*").distinct()
    if reach is None:
        kinds = [k for k in KINDS if any(k in others for others in NEEDS.values())]
        held = every.groupBy(F.col("__digest").alias("p_digest"), F.col("scope").alias("p_scope")).agg(*[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in kinds])
        enough = F.col("touched")
        for kind, others in NEEDS.items():
            enough = enough | ((F.col("kind") == kind) & (sum((F.col(f"n_{k}") for k in others), F.lit(0)) > F.col("own")))
        scopes = weak.join(held, (F.col("__digest") == F.col("p_digest")) & (F.col("scope") == F.col("p_scope")))
        return scopes.filter(enough).select("__digest", "kind", "start", "stop")
    fits = F.lit(False)
    for kind, others in NEEDS.items():
        fits = fits | ((F.col("kind") == kind) & F.col("p_kind").isin(*others))
    sides = []
    for own, other, sign in (("start", "stop", 1), ("stop", "start", -1)):  # the part ends before the candidate, or begins after it
        bins = F.array(*[F.floor(F.col(other) / reach) + sign * j for j in (0, 1)])
        near = every.select(F.col("__digest").alias("p_digest"), F.col("kind").alias("p_kind"), F.col("scope").alias("p_scope"), F.col(other).alias("p_place"), F.explode(bins).alias("p_bin"))
        gap = sign * (F.col(own) - F.col("p_place"))
        sides.append(
            weak.withColumn("bin", F.floor(F.col(own) / reach)).join(
                near, (F.col("__digest") == F.col("p_digest")) & (F.col("scope") == F.col("p_scope")) & (F.col("bin") == F.col("p_bin")) & (gap >= 0) & (gap <= reach) & fits, "left_semi"
            ).drop("bin")
        )
    return sides[0].unionByName(sides[1]).unionByName(weak.filter("touched")).distinct().select("__digest", "kind", "start", "stop")


def _sorted(spans: Column) -> Column:
    rank = lambda s: F.array_position(F.array(*[F.lit(k) for k in KINDS]), s["kind"])
    ranked = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), rank(s).alias("rank"), s["stop"].alias("stop"), s["kind"].alias("kind")))
    return F.array_sort(ranked)


def joined(spans: Column) -> Column:
    """kind:start:stop, comma-separated."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def secret_scan(docs: DataFrame, text: str = "text", carry: list[str] | None = None, reach: int | None = REACH) -> DataFrame:
    """``carry`` (all columns by default), n_assign, n_access, n_hex, base_spans and spans, both sorted arrays of structs."""
    names = ("n_assign", "n_access", "n_hex", "base_spans", "spans")
    carry = fresh(docs, *names).columns if carry is None else carry
    found = written(parts(docs, text, carry))
    weak = linked_weak(found, reach).groupBy("__digest").agg(F.collect_list(F.struct("kind", "start", "stop")).alias("more"))
    # Texts without a candidate cannot match; a key of their own keeps their copies apart.
    alone = F.concat(F.lit("-"), row_digest(found.select(*[f"`{c}`" for c in carry], "__digest")).cast("string"))
    found = found.withColumn("__key", F.when(F.size("weak") > 0, F.col("__digest")).otherwise(alone))
    out = found.join(weak.withColumnRenamed("__digest", "__weak_digest"), F.col("__key") == F.col("__weak_digest"), "left")
    count = lambda kind: F.size(F.filter("strong", lambda s: s["kind"] == kind)).cast("bigint")
    strong = F.transform("strong", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop")))
    more = F.coalesce("more", F.array().cast("array<struct<kind:string,start:bigint,stop:bigint>>"))
    return out.select(
        *[F.col(f"`{c}`") for c in carry], count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        _sorted(strong).alias("base_spans"), _sorted(F.concat(strong, more)).alias("spans"),
    )


def redact(docs: DataFrame, text: str = "text", mask: str = "[SECRET]", reach: int | None = REACH) -> DataFrame:
    """``docs`` with every reported span replaced by ``mask``; overlapping spans give one mask.

    Only digests and places are stored for the linking; each text is read where it lies, its strong finds are found again
    there and the linked weak ones are looked up by its digest.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]  # so that no column clashes with those of the scan
    schema, text = docs.schema, names[docs.columns.index(text)]
    rows = docs.toDF(*names)
    weak = written(parts(rows, text, []).filter(F.size("weak") > 0))
    linked = written(linked_weak(weak, reach).groupBy("__digest").agg(F.collect_list(F.struct("kind", "start", "stop")).alias("__more")))
    rows = attach(rows.withColumn("__digest", F.sha2(text_or_empty(text), 256)), linked, ["__digest"])

    def cover(batches):
        for batch in batches:
            texts = batch.column(text).to_pylist()
            for i, more in enumerate(batch.column("__more")):
                spans = [(s, e) for _, s, e in base_spans(texts[i] or "")] + [(m["start"], m["stop"]) for m in more.as_py() or []]
                if not spans:
                    continue
                out, at = [], 0
                for start, stop in sorted(spans):
                    if start >= at:
                        out += [texts[i][at:start], mask]
                    at = max(at, stop)
                texts[i] = "".join(out) + texts[i][at:]
            columns = {c: batch.column(c) for c in names} | {text: pa.array(texts, pa.string())}
            yield pa.record_batch([columns[c] for c in names], names=schema.names)

    return rows.mapInArrow(cover, schema)
