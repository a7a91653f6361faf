"""Word counts with the reference's four tokenisations, top words, stop
words and n-grams (X1-X6, S9).

Every variant is ``explode(split(...))`` + ``groupBy(word).count()``: the
count is a partial + final hash aggregate, so a very frequent word ("the")
is combined map-side — the Spark form of the MapReduce combiner. Whole texts
are tokenised; nothing is truncated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlake.functions.numeric import col_of
from martlake.session import written

# A small English stop-word list for the stop-word exercise.
STOP_WORDS = ["a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "has", "he",
              "in", "is", "it", "its", "of", "on", "that", "the", "to", "was", "were", "will",
              "with"]

# Java StringTokenizer's default delimiters: space, tab, newline, CR, form feed.
TOKENIZER_DELIMS = r"[ \t\n\r\f]+"


def _tokens(split_col: Column) -> Column:
    return F.filter(split_col, lambda w: w != F.lit(""))


def tokens_whitespace_lower(text) -> Column:
    """Lower-case, split on whitespace; punctuation stays in the word."""
    return _tokens(F.split(F.lower(col_of(text)), r"(?U)\s+"))


def tokens_whitespace_case(text) -> Column:
    """Split on the StringTokenizer delimiters; case kept."""
    return _tokens(F.split(col_of(text), TOKENIZER_DELIMS))


def tokens_stripped(text) -> Column:
    """Lower-case, delete characters that are neither word characters
    nor whitespace (``it's`` -> ``its``), split on whitespace."""
    cleaned = F.regexp_replace(F.lower(col_of(text)), r"(?U)[^\w\s]", "")
    return _tokens(F.split(cleaned, r"(?U)\s+"))


def tokens_nonword(text, unicode: bool = True) -> Column:
    """Lower-case, split on runs of non-word characters (``it's`` ->
    ``it``, ``s``). ``unicode=False`` reproduces Java's ASCII ``\\W`` (which
    cuts accented words apart)."""
    pattern = r"(?U)\W+" if unicode else r"\W+"
    return _tokens(F.split(F.lower(col_of(text)), pattern))


TOKENIZERS = {
    "ws": tokens_whitespace_lower,
    "case": tokens_whitespace_case,
    "stripped": tokens_stripped,
    "nonword": tokens_nonword,
}


def word_counts(df: DataFrame, text: str = "text", tokenizer: str = "ws") -> DataFrame:
    """(word, count) over all texts."""
    tok = TOKENIZERS[tokenizer](text)
    return (df.select(F.explode(tok).alias("word"))
            .groupBy("word").agg(F.count(F.lit(1)).alias("count")))


def top_words(counts: DataFrame, k: int = 20) -> DataFrame:
    """The k most frequent words, word ascending on ties."""
    return counts.orderBy(F.desc("count"), F.asc("word")).limit(k)


SUMMARY_SIZE = 1 << 16


def top_words_by_summary(df: DataFrame, k: int = 20, text: str = "text", tokenizer: str = "ws",
                         summary_size: int = SUMMARY_SIZE) -> DataFrame:
    """X5 / O4 without shuffling every word: the rows of :func:`top_words`.

    The summary of a text, a task or the corpus is the number of its words by
    hash bucket, at most ``summary_size`` numbers; summaries add up, and each
    bounds from above every word in its bucket. The words of the largest
    buckets are counted exactly. If no other bucket reaches the count at rank
    k, no word outside is among the first k, and they are the result; else all
    buckets that reach it are counted, which settles it. What is shuffled is
    summaries, and the partial counts of words in the buckets chosen.
    """
    words = df.select(F.explode(TOKENIZERS[tokenizer](text)).alias("word"))
    words = words.withColumn("bucket", F.pmod(F.xxhash64("word"), F.lit(summary_size)))
    summary = written(words.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")), "word-summary")
    sums = [r["n"] for r in summary.orderBy(F.desc("n")).limit(2 * k).collect()]
    least = sums[-1] if len(sums) == 2 * k else 0

    def counted(least: int) -> DataFrame:
        some = summary.where(F.col("n") >= least).select("bucket")   # at most summary_size rows
        return top_words(words.join(F.broadcast(some), "bucket", "left_semi").groupBy("word")
                         .agg(F.count(F.lit(1)).alias("count")), k)
    first = written(counted(least), "word-candidates")
    found, lowest = first.agg(F.count(F.lit(1)), F.min("count")).first()
    if not least or (found == k and least <= lowest):
        return first.orderBy(F.desc("count"), F.asc("word"))
    return counted(lowest if found == k else 0)


def remove_stop_words(tokens: Column, stop_words=STOP_WORDS) -> Column:
    """Drop stop words from a token array (literals looked up in a hash
    set — their number is fixed, not data dependent)."""
    return F.filter(tokens, lambda w: ~w.isin(list(stop_words)))


def ngrams(df: DataFrame, tokens, n: int = 2) -> DataFrame:
    """(ngram), one row for each n adjacent tokens of an array, joined by
    a blank.

    Built from n shifted views of the array, zipped and put in rows; the
    words of a row are joined there, once. No lambda runs for a position, so
    all of it is generated code, and a row holds n words, never the array: a
    text is walked a constant number of times.
    """
    # materialise the token array once per text: an inline expression would
    # be evaluated again for each view
    df, tok = df.select(col_of(tokens).alias("_tok")), F.col("_tok")
    m = F.greatest(F.size(tok) - F.lit(n - 1), F.lit(0))          # number of n-grams
    words = df.select(F.inline(F.arrays_zip(*[F.slice(tok, k + 1, m) for k in range(n)])))
    blank_and_word = [c for k in range(1, n) for c in (F.lit(" "), words[str(k)])]
    return words.select(F.concat(words["0"], *blank_and_word).alias("ngram"))


PIECE_BYTES = 20 << 20


def in_pieces(df: DataFrame, text: str = "text", piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """The texts, all of them. If a partition of ``df`` holds over twice
    ``piece_bytes`` of UTF-8, they are dealt out evenly, about ``piece_bytes``
    to a task; else they stay where they are, without a shuffle."""
    texts = df.select(col_of(text))
    sizes = texts.groupBy(F.spark_partition_id().alias("p")).agg(F.sum(F.octet_length(col_of(text))).alias("size"))
    size, largest = sizes.agg(F.sum("size"), F.max("size")).first()
    if (largest or 0) <= 2 * piece_bytes:
        return texts
    return texts.repartition(-(-size // piece_bytes))


def ngram_counts(df: DataFrame, text: str = "text", n: int = 2, drop_stop_words: bool = True,
                 tokenizer: str = "nonword", piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """(ngram, count): n-grams inside each text (they never span texts).

    Most n-grams of a text occur once, so the map-side combine of a task holds
    about as many keys as its texts have words. Large file splits are dealt
    out in small pieces first: they would fill a task's memory, and the combine
    would sort and spill strings.
    """
    tok = TOKENIZERS[tokenizer](text)
    if drop_stop_words:
        tok = remove_stop_words(tok)
    return ngrams(in_pieces(df, text, piece_bytes), tok, n).groupBy("ngram").agg(F.count(F.lit(1)).alias("count"))
