"""Secret scans with multipart credential linking.

Parts of credentials are found as spans of the text, by kind:

======== ========== ============================================ ========
kind     role       pattern                                      reported
======== ========== ============================================ ========
assign   secret     a password-like name, : or =, 6+ characters  always
access   identifier AKIA and 16+ capitals or digits              always
hex      secret     24+ hexadecimal digits                       always
ident    identifier a user-like name, : or =, 3+ characters      if linked
endpoint endpoint   a web address or host:port                   if linked
weak     secret     16+ characters with digits and letters       if linked
======== ========== ============================================ ========

The last three are weak alone. An interval join looks for the other parts of a
credential within ``SCOPE`` code points around each of them: an identifier
needs a secret, a secret an identifier, an endpoint both. Parts that overlap
do not complete each other, and a weak span that overlaps an always reported
one is the same finding and goes.

Positions. Spark's regular expressions give the matches and, as a split, what
lies between them; the running sum of both lengths is the position. Only these
small rows are shuffled, no text. The join is on the text and on buckets of
``BUCKET`` code points; spans of a kind do not overlap, so a bucket holds a
bounded number of them however many a text has.

Defined results: a null text counts as empty and has no spans; a null id is
kept; rows that repeat are scanned each for itself; texts of any length are
scanned whole, in time that grows with the length; an empty table gives no rows;
further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlake.llm.common import text_of, written

SCOPE = 200
BUCKET = 512
#: Kind: (order, role, pattern). Failing matches of ``assign`` and ``weak``
#: are dropped after matching. Host names have at most 16 labels of at most 63
#: characters, so the time for a text grows with its length alone.
KINDS = {
    "assign": (1, "secret", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    "access": (2, "identifier", r"AKIA[A-Z0-9]{16,}"),
    "hex": (3, "secret", r"[0-9a-f]{24,}"),
    "ident": (4, "identifier", r"""(?i:user(?:_?name)?|login|account|client_?id|key_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}"""),
    "endpoint": (5, "endpoint", r"""https?://[^\x20\x09-\x0D"'<>]+|[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,15}:[0-9]{2,5}"""),
    "weak": (6, "secret", r"[A-Za-z0-9+/_-]{16,}"),
}
STRONG = ("assign", "access", "hex")


def _matches(text: Column, kind: str) -> Column:
    """array<struct<kind, n, gap, len, holds>>: matches, with the gap before
    each measured from the end of the match before, and whether it holds."""
    pattern = F.lit(KINDS[kind][2])
    parts = [F.regexp_extract_all(text, pattern, F.lit(0)), F.split(text, KINDS[kind][2], -1)]
    if kind == "assign":
        parts.append(F.regexp_extract_all(text, pattern, F.lit(2)))
    # Zipped, so that no part is made again for each match; the last gap has no match.
    zipped = F.filter(F.arrays_zip(*parts), lambda x: x["0"].isNotNull())
    found = F.transform(zipped, lambda x, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("n"), F.char_length(x["1"]).alias("gap"), F.char_length(x["0"]).alias("len"),
        (F.char_length(x["2"]) >= 6 if kind == "assign" else
         (x["0"].rlike("[0-9]") & x["0"].rlike("[A-Za-z]")) if kind == "weak" else F.lit(True)).alias("holds")))
    none = F.array().cast("array<struct<kind:string,n:int,gap:int,len:int,holds:boolean>>")
    return F.when(text.rlike(KINDS[kind][2]), found).otherwise(none)


def _spans(found: DataFrame) -> DataFrame:
    """(rid, kind, start, end) of all parts; ``end`` is exclusive."""
    rows = found.select("rid", F.explode(F.concat(*KINDS)).alias("m")).select("rid", "m.*")
    upto = Window.partitionBy("rid", "kind").orderBy("n")
    return (rows.withColumn("end", F.sum(F.col("gap").cast("long") + F.col("len")).over(upto))
            .filter("holds")
            .select("rid", "kind", (F.col("end") - F.col("len")).alias("start"), "end"))


def _role(kind: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for k, v in KINDS.items() for x in (k, v[1])]), kind)


def _in_buckets(df: DataFrame, first: Column, last: Column) -> DataFrame:
    return df.withColumn("bucket", F.explode(F.sequence(
        F.floor(F.greatest(first, F.lit(0)) / BUCKET), F.floor(F.greatest(last, F.lit(0)) / BUCKET))))


def _linked(spans: DataFrame, scope: int) -> DataFrame:
    """The weak spans whose complementary parts lie in their scope."""
    weak = spans.filter(~F.col("kind").isin(*STRONG))
    weak = _in_buckets(weak, F.col("start") - scope, F.col("end") + scope - 1)
    parts = spans.select("rid", F.col("kind").alias("other"), F.col("start").alias("from"), F.col("end").alias("to"))
    parts = _in_buckets(parts, F.col("from"), F.col("to") - 1)
    apart = (F.col("to") <= F.col("start")) | (F.col("from") >= F.col("end"))
    near = (F.col("to") > F.col("start") - scope) & (F.col("from") < F.col("end") + scope)
    pairs = weak.join(parts, ["rid", "bucket"]).filter(near)
    role = _role(F.col("other"))
    flags = pairs.groupBy("rid", "kind", "start", "end").agg(
        F.max(apart & (role == "identifier")).alias("identifier"),
        F.max(apart & (role == "secret")).alias("secret"),
        F.max(~apart & F.col("other").isin(*STRONG)).alias("known"))
    own = _role(F.col("kind"))
    complete = ((own == "secret") | F.col("secret")) & ((own == "identifier") | F.col("identifier"))
    return flags.filter(~F.col("known") & complete).select("rid", "kind", "start", "end")


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 scope: int = SCOPE) -> DataFrame:
    """One row per row of ``docs``: ``id`` and ``spans``, an array of (start,
    rank, kind, end) in order, with code points and ``end`` exclusive."""
    base = docs.select(F.monotonically_increasing_id().alias("rid"),
                       F.col(f"`{id_col}`").cast("long").alias("id"), text_of(f"`{text_col}`").alias("text"))
    found = written(base.select("rid", "id", *[_matches(F.col("text"), k).alias(k) for k in KINDS]),
                    "secrets-found", wide=True)
    spans = written(_spans(found), "secrets-spans")
    all_spans = spans.filter(F.col("kind").isin(*STRONG)).unionByName(_linked(spans, scope))
    rank = F.element_at(F.create_map(*[F.lit(x) for k, v in KINDS.items() for x in (k, v[0])]), F.col("kind"))
    by_text = all_spans.groupBy("rid").agg(F.sort_array(F.collect_list(
        F.struct("start", rank.alias("rank"), "kind", "end"))).alias("spans"))
    none = F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>")
    return (found.select("rid", "id").join(by_text, "rid", "left")
            .select("id", F.coalesce("spans", none).alias("spans")))


def written_spans(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
