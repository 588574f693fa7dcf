"""Secret scans with multipart credential linking, in DataFrame functions only.

Strong patterns are reported wherever they stand. Weak parts - account identifiers, short or
loosely named secrets, endpoints - are reported only where complementary parts stand in the
same scope: an identifier near a secret, a secret near an identifier, an endpoint near both.
Parts are joined as intervals: scopes are cut into bins as wide as the scope, each bin keeps
the least start and the greatest end of the parts of a role that touch it, and a weak part
meets the bins that its scope touches. That decides exactly whether such a part is in scope
without listing pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import stage

# The base patterns. Runs that are too short never hold a longer one, so length
# limits of access and hex stand in the pattern; a short assignment still uses up its text.
_NAME = r"(?i:password|passwd|secret|token|api_?key)"
_SEP = r"[\"']?\x20*[:=]\x20*[\"']?"
ASSIGN = rf"({_NAME}){_SEP}([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
ASSIGN_LEAST = 8

# weak parts
WEAK_ID = (rf"(?i:access_?key(?:_?id)?|client_?id|account(?:_?id)?|user(?:_?name|_?id)?|login){_SEP}"
           r"[A-Za-z0-9+/_.@-]{3,}|AKIA[A-Z0-9]{4,11}(?![A-Z0-9])")
WEAK_SECRET = rf"(?i:pwd|pass|passphrase|private_?key|auth|bearer|credential){_SEP}[A-Za-z0-9+/_.=-]{{6,}}"
ENDPOINT = r"(?i:https?|jdbc:[a-z]+|s3|ftp|ssh)://[^\x20\x09-\x0D\"'<>]+|(?i:host|endpoint|server)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9.:-]{4,}"

#: Order of kinds; the first three are the base.
KINDS = ["assign", "access", "hex", "weak_id", "weak_secret", "endpoint"]
#: Code points between parts of one scope.
SCOPE = 200

_PART = "struct<start:bigint,kind:int,end:bigint>"
_BLOCK = 256


def _matches(text: Column, pattern: str, kind: int, keep=None) -> Column:
    """Spans of the leftmost non-overlapping matches, in code points, end exclusive.

    Matches and the gaps between them alternate, so positions are running sums of their
    lengths, taken within blocks and over blocks.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    steps = F.zip_with(found, F.slice(gaps, F.lit(1), F.size(found)), lambda m, g: F.struct(
        F.char_length(g).cast("long").alias("gap"), F.char_length(m).cast("long").alias("len"),
        (keep(m) if keep else F.lit(True)).alias("keep")))

    def within(block: Column, base: Column) -> Column:
        start = F.struct(base.alias("at"), F.array().cast(f"array<{_PART}>").alias("spans"))

        def step(acc: Column, s: Column) -> Column:
            at = acc["at"] + s["gap"]
            one = F.array(F.struct(at.alias("start"), F.lit(kind).alias("kind"), (at + s["len"]).alias("end")))
            return F.struct((at + s["len"]).alias("at"), F.when(s["keep"], F.concat(acc["spans"], one)).otherwise(
                acc["spans"]).cast(f"array<{_PART}>").alias("spans"))

        return F.aggregate(block, start, step, lambda acc: acc["spans"])

    def blocks(steps: Column) -> Column:
        count = F.ceil(F.size(steps) / _BLOCK).cast("int")
        cut = F.transform(F.sequence(F.lit(0), count - 1), lambda b: F.slice(steps, b * _BLOCK + 1, F.lit(_BLOCK)))
        sums = F.transform(cut, lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, s: a + s["gap"] + s["len"]))
        bases = F.aggregate(sums, F.array(F.lit(0).cast("long")), lambda a, s: F.concat(a, F.array(F.element_at(a, -1) + s)))
        return F.flatten(F.zip_with(cut, F.slice(bases, F.lit(1), count), within))

    none = F.array().cast(f"array<{_PART}>")
    return F.when(F.coalesce(text.rlike(pattern), F.lit(False)), blocks(steps)).otherwise(none)


def _value(match: Column) -> Column:
    return F.char_length(F.regexp_extract(match, ASSIGN, 2))


def find_parts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Base spans and weak parts of each row of a table: (rid, id, base, weak). Staged."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    assign = _matches(text, ASSIGN, 0, lambda m: _value(m) >= ASSIGN_LEAST)
    short = _matches(text, ASSIGN, 4, lambda m: (_value(m) >= 4) & (_value(m) < ASSIGN_LEAST))
    base = F.concat(assign, _matches(text, ACCESS, 1), _matches(text, HEX, 2))
    weak = F.concat(_matches(text, WEAK_ID, 3), short, _matches(text, WEAK_SECRET, 4), _matches(text, ENDPOINT, 5))
    return stage(docs.select(
        F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("id"),
        F.array_sort(base).alias("base"), F.array_sort(weak).alias("weak")), "secret-parts")


def link_parts(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Weak parts with complementary parts in scope: (rid, linked), an array a row."""
    role = F.when(F.col("p.kind").isin(0, 2, 4), "secret").when(F.col("p.kind").isin(1, 3), "id").otherwise("endpoint")
    rows = parts.where(F.size("weak") > 0)
    each = rows.select("rid", F.explode(F.concat("base", "weak")).alias("p")).select(
        "rid", role.alias("role"), "p.start", "p.end")
    touched = each.where("role <> 'endpoint'").withColumn("bin", F.explode(F.sequence(
        F.floor(F.col("start") / scope), F.floor((F.col("end") - 1) / scope))))
    bins = touched.groupBy("rid", "bin").agg(*(
        f(F.when(F.col("role") == r, F.col(c))).alias(f"{r}_{c}")
        for r in ("id", "secret") for f, c in ((F.min, "start"), (F.max, "end"))))
    weak = rows.select("rid", F.explode("weak").alias("p")).select("rid", "p.start", "p.kind", "p.end").distinct()
    weak = weak.withColumn("bin", F.explode(F.sequence(
        F.floor((F.col("start") - scope) / scope), F.floor((F.col("end") + scope) / scope))))

    def near(r: str) -> Column:
        return F.max((F.col(f"{r}_start") <= F.col("end") + scope) & (F.col(f"{r}_end") >= F.col("start") - scope)).alias(r)

    met = weak.join(bins, ["rid", "bin"]).groupBy("rid", "start", "kind", "end").agg(near("id"), near("secret"))
    wanted = F.when(F.col("kind") == 3, F.col("secret")).when(F.col("kind") == 4, F.col("id")).otherwise(
        F.col("id") & F.col("secret"))
    return met.where(wanted).groupBy("rid").agg(F.collect_list(F.struct("start", "kind", "end")).alias("linked"))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """One row per document: ``id_col``, base and spans, arrays of (start, kind, end) by start.

    ``kind`` is a place in ``KINDS``; base holds the strong patterns, spans those and the weak
    parts that complementary parts in scope (at most ``scope`` code points away) confirm.
    Positions are code points, end exclusive. A weak part may overlap a base span.

    Null and empty texts have no spans. Rows that repeat an id are scanned one by one; null ids
    stay null. Other columns are ignored. No rows give no rows.
    """
    parts = find_parts(docs, id_col, text_col)
    linked = link_parts(parts, scope)
    none = F.array().cast(f"array<{_PART}>")
    return parts.join(linked, "rid", "left").select(
        F.col("id").alias(id_col), "base",
        F.array_sort(F.concat("base", F.coalesce("linked", none))).alias("spans"))


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))))
