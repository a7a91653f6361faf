"""Document fingerprints: a Merkle tree over paragraphs and sections.

The leaves are pieces of a paragraph (a line with its line feed), cut by content:
behind a blank that follows a sign of ``[^ g-z]``, after ``LEAF`` code points at
the latest. So an edit voids the leaves around it only, a text of one line too
keeps those away from the edit, and an insertion moves no cut but the next ones.
A paragraph's node is the hash of its leaves; a section ends behind a blank
paragraph, or where the paragraph's hash begins with 0 or 1, so an edit moves
no other section's borders; its node is the hash of its paragraphs. The root,
a SHA-256 of the sections' hashes, is equal for equal texts; hashes below it have
64 bits, so different texts share a root if two of their pieces collide.

A fingerprint is written as ``root|section/section/...`` with the paragraphs
of a section separated by ``;`` and their leaves (hash.length) by ``,``. All
inner nodes follow from the leaves, so two fingerprints can be compared from
the root down: ``differing_paragraphs`` walks only into sections that differ.
Their likeness is 1 for equal roots, else twice the code points of common
leaves (each leaf once) over those of both.

Edited texts need the next document by id. Only ids go through the ordering:
they are dealt by range, followed within each range, and the first ids of the
ranges (one row each) tie the ends together. Texts are dealt by id once;
each then passes on to its predecessor.

Defined results: a null text counts as empty; the empty text has the root of
no sections and no leaves, and is wholly like another empty text; a null id is
the smallest id; rows that repeat an id have the same successor, the next
larger id (of its rows the one with the smallest text hash); after the largest
id comes the smallest, for a single id itself; an empty table gives no rows;
further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlake.llm.common import text_of, written

LEAF = 32
LEAF_PATTERN = f"[^\n]{{0,{LEAF - 2}}}?[^ \ng-z] |[^\n]{{1,{LEAF}}}\n?|\n"
_NULL_ID = -(1 << 63)


def _short(value: Column) -> Column:
    return F.substring(F.md5(value), 1, 16)


def _with_tree(df: DataFrame, text: str, to: str) -> DataFrame:
    """``df`` with ``{to}`` (the fingerprint) and ``{to}_leaves``."""
    blocks = F.regexp_extract_all(F.col(text), F.lit(LEAF_PATTERN), F.lit(0))
    df = df.withColumn("_leaves", F.transform(blocks, lambda b: F.concat(
        _short(b), F.lit("."), F.char_length(b).cast("string"),
        F.when(F.endswith(b, F.lit("\n")), F.lit(";")).otherwise(F.lit(",")))))
    paragraphs = F.regexp_extract_all(F.array_join("_leaves", ""), F.lit("[^;]+;?"), F.lit(0))
    blank = _short(F.lit("\n"))
    df = df.withColumn("_paragraphs", F.transform(paragraphs, lambda p: F.concat(
        p, F.when(F.startswith(p, F.concat(blank, F.lit(".1;"))) | _short(p).rlike("^[01]"),
                  F.lit("/")).otherwise(F.lit("")))))
    df = df.withColumn("_body", F.array_join("_paragraphs", ""))
    sections = F.regexp_extract_all("_body", F.lit("[^/]+/?"), F.lit(0))
    nodes = F.transform(sections, lambda s: _short(F.array_join(F.transform(
        F.regexp_extract_all(s, F.lit("[^;]+;?/?"), F.lit(0)), lambda p: _short(p)), "")))
    return (df.withColumn(to, F.concat(F.sha2(F.array_join(nodes, ""), 256), F.lit("|"), "_body"))
            .withColumn(f"{to}_leaves", F.transform("_leaves", lambda x: F.rtrim(x, F.lit(",;"))))
            .drop("_leaves", "_paragraphs", "_body"))


def _length(leaves: Column) -> Column:
    return F.aggregate(leaves, F.lit(0).cast("long"), lambda s, x: s + F.substring_index(x, ".", -1).cast("long"))


def likeness(a: str, b: str) -> Column:
    """Likeness of the fingerprints in columns ``a`` and ``b`` (with their
    ``_leaves``), 0 to 1."""
    la, lb = F.array_distinct(f"{a}_leaves"), F.array_distinct(f"{b}_leaves")
    both = 2 * _length(F.array_intersect(f"{a}_leaves", f"{b}_leaves"))
    return (F.when(_root(F.col(a)) == _root(F.col(b)), F.lit(1.0))
            .otherwise(both / (_length(la) + _length(lb))))


def _root(fingerprint: Column) -> Column:
    return F.substring_index(fingerprint, "|", 1)


def differing_paragraphs(a: Column, b: Column) -> Column:
    """Paragraphs of ``a`` (numbered from 0) that lie in sections which ``b``
    lacks and are missing in ``b`` themselves; empty for equal roots."""
    def parts(body, pattern):
        return F.regexp_extract_all(body, F.lit(pattern), F.lit(0))
    body_a, body_b = F.substring_index(a, "|", -1), F.substring_index(b, "|", -1)
    known_sections, known = parts(body_b, "[^/]+/?"), parts(body_b, "[^;]+;?/?")
    own = F.flatten(F.transform(parts(body_a, "[^/]+/?"), lambda s: F.transform(
        parts(s, "[^;]+;?/?"), lambda p: F.struct(p.alias("p"), F.array_contains(known_sections, s).alias("same")))))
    numbers = F.transform(own, lambda x, i: F.when(
        ~x["same"] & ~F.array_contains(known, x["p"]), i))
    return F.when(_root(a) == _root(b), F.array().cast("array<int>")).otherwise(F.array_compact(numbers))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint, fingerprint_leaves) of every row; moves nothing."""
    base = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text_of(f"`{text_col}`").alias("text"))
    return _with_tree(base, "text", "fingerprint").drop("text")


def in_order(ids: DataFrame) -> DataFrame:
    """``ids`` (distinct in ``k``) dealt by range, with the range as ``part``;
    a written table, since the ranges come from a sample."""
    return written(ids.repartitionByRange("k").withColumn("part", F.spark_partition_id()), "fingerprint-order")


def successors(dealt: DataFrame) -> DataFrame:
    """(k, next_k) from ``in_order``: each id and the next larger one, for the
    largest the smallest."""
    firsts = dealt.groupBy("part").agg(F.min("k").alias("first"))
    by_part = Window.orderBy("part")  # one row for each range
    firsts = firsts.select("part", F.coalesce(
        F.lead("first").over(by_part),
        F.first("first").over(by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ).alias("after"))
    following = F.lead("k").over(Window.partitionBy("part").orderBy("k"))
    return (dealt.withColumn("next", following).join(firsts, "part")
            .select("k", F.coalesce("next", "after").alias("next_k")))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id``, ``n_chars``, ``edited`` (the text
    whose last half is replaced by the next document's beginning),
    ``fingerprint``, ``edited_fingerprint``, ``near_edited``, ``near_next``."""
    texts = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(_NULL_ID)).alias("k"),
                        text_of(f"`{text_col}`").alias("text"))
    ids = in_order(texts.select("k", F.xxhash64("text").alias("h"))
                   .groupBy("k").agg(F.min("h").alias("h"), F.count(F.lit(1)).alias("n")))
    follow = successors(ids)
    giver = texts.withColumnRenamed("k", "next_k").withColumnRenamed("text", "next_text")
    repeats = bool(ids.filter("n > 1").limit(1).count())
    if repeats:
        follow = follow.join(ids.select(F.col("k").alias("next_k"), F.col("h").alias("next_h")), "next_k")
        giver = giver.withColumn("h", F.xxhash64("next_text"))
    given = giver.join(follow, "next_k")
    if repeats:
        given = given.filter(F.col("h") == F.col("next_h")).dropDuplicates(["k"])
    # The text goes to its predecessor, which makes its leaves: they are longer than the text.
    both = texts.join(given.select("k", "next_text"), "k").withColumn("n_chars", F.char_length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    both = both.withColumn("edited", F.concat(
        F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - half),
        F.substring(F.col("next_text"), F.lit(1), half)))
    both = _with_tree(both, "next_text", "next_fp")
    both = _with_tree(_with_tree(both, "text", "fingerprint"), "edited", "edited_fingerprint")
    return both.select(
        F.when(F.col("k") != _NULL_ID, F.col("k")).alias("id"), "n_chars", "edited", "fingerprint",
        "edited_fingerprint", likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        likeness("fingerprint", "next_fp").alias("near_next"))
