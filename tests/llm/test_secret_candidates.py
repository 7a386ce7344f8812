import public_tokenizers
import pytest

from folioframe.llm import secret_scan as S

PATH = "hooks/services/" + "_".join(["segment", "folder"] * 5) + "/"
HARD = [
    ("the password\t= b7db7aa4a5fcc78305 end", "b7db7aa4a5fcc78305"),
    ("the password   =   b7db7aa4a5fcc78305 end", "b7db7aa4a5fcc78305"),
    ("the api_key\t:\tQkdWzXhTpLbVnRsYmJgC end", "QkdWzXhTpLbVnRsYmJgC"),
    ("my password = x7Kq2Z end", "x7Kq2Z"),
    ("a bare QkdWzXhTpLbVnRsYmJgCfHtK run", "QkdWzXhTpLbVnRsYmJgCfHtK"),
    ("a bare Zk3Wq9XhT7pLbV2nRsY8mJgC run", "Zk3Wq9XhT7pLbV2nRsY8mJgC"),
    (f"post to {PATH}Zk3Wq9XhT7pLbV2nRsY8mJgCfHtK4d now", f"{PATH}Zk3Wq9XhT7pLbV2nRsY8mJgCfHtK4d"),
]
PLAIN = ["the token: the end", "a password: none", "password = secret", "thanonontioniner words internationalization", "AbstractSessionFactoryBuilder here", "see a/long/folder/without/any/digits/in/it", "some_long_snake_case_name_for_a_thing", "Schpfgegebeunger"]


@pytest.fixture(scope="module")
def forest(spark):
    return S.train(spark, words=S.dictionary(public_tokenizers.path("byte_bpe_50k.tiktoken")))


def test_hard_secrets_are_found_and_masked(spark, forest):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(HARD)], "doc_id long, text string")
    got = {r.doc_id: (r.start, r.secret) for r in S.scan(docs, forest).collect()}
    assert got == {i: (t.index(s), s) for i, (t, s) in enumerate(HARD)}
    assert {r.doc_id: r.text for r in S.redact(docs, forest).collect()} == {i: t.replace(s, S.MASK) for i, (t, s) in enumerate(HARD)}


def test_plain_words_and_names_stay(spark, forest):
    docs = spark.createDataFrame(list(enumerate(PLAIN)), "doc_id long, text string")
    assert S.scan(docs, forest).collect() == []
