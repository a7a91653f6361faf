"""Word-count queries over ``documents.text``."""

from __future__ import annotations

from martlake.operators import text as X
from martlake.plans.registry import query
from martlake.sources import tables as T

_STOP_SQL = "[" + ", ".join(f"'{w}'" for w in X.STOP_WORDS) + "]"
# DuckDB's regex engine is ASCII for \w / \W; spell the Unicode classes out.
_NONWORD = r"[^\p{L}\p{N}_]+"


def _docs(spark, d):
    return T.documents(spark, d)


@query("wordcount_ws", r"""
SELECT word, COUNT(*) AS count FROM (
  SELECT unnest(regexp_split_to_array(lower(text), '\s+')) AS word FROM documents)
WHERE word <> '' GROUP BY word""")
def wordcount_ws(spark, d):
    """Lower-case, whitespace tokens, punctuation kept."""
    return X.word_counts(_docs(spark, d), "text", "ws")


@query("wordcount_case", r"""
SELECT word, COUNT(*) AS count FROM (
  SELECT unnest(regexp_split_to_array(text, '[ \t\n\r\f]+')) AS word FROM documents)
WHERE word <> '' GROUP BY word""")
def wordcount_case(spark, d):
    """StringTokenizer tokens, case kept."""
    return X.word_counts(_docs(spark, d), "text", "case")


@query("wordcount_stripped", r"""
SELECT word, COUNT(*) AS count FROM (
  SELECT unnest(regexp_split_to_array(regexp_replace(lower(text), '[^\p{L}\p{N}_\s]', '', 'g'), '\s+')) AS word
  FROM documents)
WHERE word <> '' GROUP BY word""")
def wordcount_stripped(spark, d):
    """Punctuation deleted before the split."""
    return X.word_counts(_docs(spark, d), "text", "stripped")


@query("wordcount_nonword", f"""
SELECT word, COUNT(*) AS count FROM (
  SELECT unnest(regexp_split_to_array(lower(text), '{_NONWORD}')) AS word FROM documents)
WHERE word <> '' GROUP BY word""")
def wordcount_nonword(spark, d):
    """Split on non-word runs (Unicode-aware)."""
    return X.word_counts(_docs(spark, d), "text", "nonword")


@query("top_words", f"""
SELECT word, COUNT(*) AS count FROM (
  SELECT unnest(regexp_split_to_array(lower(text), '{_NONWORD}')) AS word FROM documents)
WHERE word <> '' GROUP BY word ORDER BY count DESC, word LIMIT 20""")
def top_words(spark, d):
    """The 20 most frequent words."""
    return X.top_words(X.word_counts(_docs(spark, d), "text", "nonword"), 20)


@query("top_words_summary", f"""
SELECT word, COUNT(*) AS count FROM (
  SELECT unnest(regexp_split_to_array(lower(text), '{_NONWORD}')) AS word FROM documents)
WHERE word <> '' GROUP BY word ORDER BY count DESC, word LIMIT 50""")
def top_words_summary(spark, d):
    """The 50 most frequent words by summaries and a recount."""
    return X.top_words_by_summary(_docs(spark, d), 50, "text", "nonword")


@query("ngrams", f"""
WITH t AS (
  SELECT doc_id, [w FOR w IN regexp_split_to_array(lower(text), '{_NONWORD}')
                  IF w <> '' AND NOT list_contains({_STOP_SQL}, w)] AS tok
  FROM documents)
SELECT ngram, COUNT(*) AS count FROM (
  SELECT tok[i] || ' ' || tok[i + 1] AS ngram
  FROM t, range(1, len(tok)) r(i))
GROUP BY ngram""")
def ngrams(spark, d):
    """Stop words removed, then bigram counts."""
    return X.ngram_counts(_docs(spark, d), "text", 2, True, "nonword")


@query("trigrams", f"""
WITH t AS (
  SELECT doc_id, [w FOR w IN regexp_split_to_array(lower(text), '{_NONWORD}')
                  IF w <> '' AND NOT list_contains({_STOP_SQL}, w)] AS tok
  FROM documents)
SELECT ngram, COUNT(*) AS count FROM (
  SELECT tok[i] || ' ' || tok[i + 1] || ' ' || tok[i + 2] AS ngram
  FROM t, range(1, len(tok) - 1) r(i))
GROUP BY ngram""")
def trigrams(spark, d):
    """Stop words removed, then trigram counts."""
    return X.ngram_counts(_docs(spark, d), "text", 3, True, "nonword")
