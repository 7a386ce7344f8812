"""What patterns need, against Java's own matcher: a text that a pattern matches always holds one of its literals."""

import pytest
from pyspark.sql import functions as F

from folioframe.operators import joins as J
from folioframe.operators import literals
from folioframe.operators.literals import FOLD, required
from folioframe.plans import validators as V

CASES = [
    (r"(?i)\bthe [a-z]+tion\b", {"the "}),
    (r"colou?r", {"colo"}),
    (r"ab+cd", {"bcd"}),
    (r"x{2,}yz", {"xyz"}),
    (r"foo|barn", {"foo", "barn"}),
    (r"foo|b", set()),
    (r"(?:alpha|beta)\s+\d{2}", {"alpha", "beta"}),
    (r"(?:alpha|beta)?gamma", {"gamma"}),
    (r"(?<!pre)word(?=ing)", {"word"}),
    (r"\Qa.b(c\E+", {"a.b(c"}),
    (r"(?<name>abc)\k<name>", set()),
    (r"[a[bc]]def", set()),
    (r"(?x) a b c d", set()),
    (r"(?iU)café noir", {" noir"}),
    (r"café", {"café"}),
    (r"KELVIN", {"kelvin"}),
    (r"[0-9]{4,}", set()),
    (r"^$", set()),
    ("", set()),
    (r"\p{Lu}abc\.", {"abc."}),
    (r"(abc", set()),
    (r"abc)", set()),
    (r"(?isU)^(?:(?!\bgen\b\.).)*\bgen\b\..{0,15}?\d+", {"gen."}),
]
TEXTS = ["the notion", "The Station", "color", "colour", "abbbcd", "acd", "xxyz", "xyz", "foo", "a barn", "ALPHA 12", "beta  99", "gamma", "wording", "prewording", "a.b(c", "a.b(cc", "CAFÉ NOIR", "café noir", "café", "KELVIN", "kelvin", "KELVIN", "12345", "", "Xabc.", "see Gen. 3", "GEN. 14", "maſſ", None]


@pytest.mark.parametrize(("pattern", "want"), CASES)
def test_literals(pattern, want):
    assert required(pattern) == want


def test_a_match_holds_a_literal(spark, monkeypatch):
    """Every pattern on every text, rules of the validators included, by Spark's matcher."""
    good = [p for p, _ in CASES if p not in ("(abc", "abc)")] + ["(?iU)mass", "(?iU)kelvin"]
    patterns = spark.createDataFrame([(p,) for p in good], "p string").union(V.citation_rules(spark).select("lat"))
    texts = spark.createDataFrame(list(enumerate([*TEXTS, "Vide Matth. cap. 3, & Gen. 1. ver. 4, lib. 2. cap. 7. tom. 3. pag. 12"])), "id int, t string")
    brute = [(r.id, r.t, r.p) for r in texts.crossJoin(patterns.distinct()).where(F.rlike("t", "p")).collect()]
    for _, t, p in brute:
        need = required(p)
        assert not need or any(x in t.translate(FOLD) for x in need), (t, p)
    for few in (0, 1000):
        monkeypatch.setattr(literals, "FEW", few)
        got = sorted((r.id, r.p) for r in J.matching_rules(texts, "t", patterns.distinct(), "p").collect())
        assert got == sorted((i, p) for i, _, p in brute)


def test_rules_with_literals_need_no_nested_loop(spark):
    texts = spark.createDataFrame([(1, "a word here"), (2, "none")], "id int, t string")
    rules = spark.createDataFrame([("r", r"\bword\b"), ("same", r"\bword\b")], "rule string, p string")
    x = J.matching_rules(texts, "t", rules, "p")
    assert sorted((r.id, r.rule) for r in x.collect()) == [(1, "r"), (1, "same")]
    assert "NestedLoop" not in x._jdf.queryExecution().executedPlan().toString()
