"""Token counts against the library."""

import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from martlake.llm import token_counts as K
from martlake.llm.common import tokenizer_path

PATH = tokenizer_path(K.MODEL)
MODEL = sentencepiece.SentencePieceProcessor(model_file=PATH)
TEXTS = ["", " ", "  ", "\n", "\n\n", " \n ", "a", " a", "a ", "a  ", "a  b\n  c\nd \n", "▁a▁▁b▁", "<s> </s> <unk>",
         "<0x0A>", "tab\tx\r\ny", "日本語 テキスト", "é ﬁ ½ 　z", "x" * 3000, "\U0001f600 \x00 a", "the the the of",
         "é ‍ b"]


def test_equals_the_library():
    for table in ({}, {"a": 1, "": 1, "the": 1}):
        c = K.TwoTierCounter(PATH, table, cache_size=5)
        for t in TEXTS * 2:
            assert c.tokens(t) == len(MODEL.encode(t)), repr(t)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t▁aeTh.,<s>é"), st.characters(exclude_categories=["Cs"])), max_size=40))
def test_random_texts(text):
    assert K.TwoTierCounter(PATH, {}).tokens(text) == len(MODEL.encode(text))


def test_documents(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "a b"), (3, None), (3, None)]
    df = spark.createDataFrame([(i, t, 5, "w") for i, t in rows],
                               "doc_id long, text string, n_tokens long, word string").repartition(3)
    got = K.token_counts(df, PATH, limit=3, table_size=4, summary_size=6).collect()
    want = [(i, len((t or "").encode()), len(MODEL.encode(t or "")), len(MODEL.encode(t or "")) > 3) for i, t in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert K.token_counts(df.limit(0), PATH).count() == 0


def test_table_holds_the_frequent_words(spark):
    df = spark.createDataFrame([("the cat the",), ("the dog\nthe",), (None,)], "text string").repartition(2)
    assert K.frequent_table(df, PATH, table_size=2) == {"the": 1}
    assert set(K.frequent_table(df, PATH)) == {"the", "cat", "dog", "\nthe", ""}
    assert K.frequent_table(df.limit(0), PATH) == {}
