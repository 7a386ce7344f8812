import pytest
from pyspark.sql import functions as F

from folioframe.functions import pages as P
from folioframe.functions import text as T
from folioframe.plans import pages as PP


def one(spark, column, text=None):
    return spark.range(1).select(F.lit(text).cast("string").alias("t")).select(column.alias("x")).head()[0]


def test_repairs(spark):
    assert one(spark, P.normalize_ae(F.col("t")), "Przedixit prz quse Ztern terré") == "Praedixit prae quae aetern terrae"
    assert one(spark, P.normalize_open_c(F.col("t")), "anno CID I2C") == "anno CIƆ IƆC"


def test_inline_markers(spark):
    got = one(spark, P.inline_markers(F.col("t")), "Arnobius^y et^2 alii")
    assert got["text"] == "Arnobius et alii" and [tuple(m) for m in got["markers"]] == [("y", 8), ("2", 11)]
    plain = one(spark, P.inline_markers(F.col("t")), "none")
    assert plain["text"] == "none" and plain["markers"] == []


def test_stitch(spark):
    pages = F.array(F.lit("First page be-\n\nlieves .\n''\na  See there\n12\n"), F.lit("  lieving ,\nthe end\n"))
    assert one(spark, P.stitch_pages(pages)) == "First page believes. lieving, the end"
    # Numbers and notes go at the foot alone, notes under a number stay; a hyphen before a sign stays.
    assert one(spark, P.stitch_pages(F.array("t")), "12\na  See it\ntext-\n, more\nb  Also\n'\u201d'\n7\n 123 \n") == "12 a See it text-, more b Also"
    assert one(spark, P.stitch_pages(F.array("t")), "1\n22\n") == "" and one(spark, P.stitch_pages(F.array("t")), "1234\na-\nb-\nc") == "1234 abc"


@pytest.mark.parametrize(("text", "want"), [("One. Two! See Lib. 3 there. \"Said.\" End", ["One.", "Two!", "See Lib. 3 there.", '"Said."', "End"]), ("St. John", ["St. John"]), ("", []), ("See cap.\n 3. Best. Est. i.e. that! No? yes (vid. x) ...Lib. y", ["See cap. 3.", "Best.", "Est.", "i.e. that!", "No? yes (vid. x) ...Lib. y"]), ("Lib.\" x a.d. ", ["Lib.\"", "x a.d."])])
def test_sentences(spark, text, want):
    assert one(spark, P.split_sentences(F.col("t")), text) == want


def test_tokens(spark):
    assert one(spark, P.fold_tokens(F.col("t")), "Cæsar & ſanctus Éa_2") == ["caesar", "and", "sanctus", "ea", "2"]
    assert one(spark, P.strip_accents(F.col("t")), "λόγος é") == "λογος e"


@pytest.mark.parametrize(("text", "kind", "citation"), [("Gen. 1.1 x", "scripture", "Gen. 1:1"), ("1 Reg. 8.27", "scripture", "1 Reg. 8:27"), ("Matth. 5", "scripture", "Matth. 5"), ("Plinius", "unknown", "")])
def test_marginals(spark, text, kind, citation):
    assert tuple(one(spark, P.classify_marginal(F.col("t")), text)) == (kind, citation)


def test_headings(spark):
    at = lambda f, t, en: one(spark, f(F.col("t"), F.lit(en)), t)
    assert at(P.detect_chapter, "CHAPTER XIV.", True) == 14
    assert at(P.detect_chapter, "CAPVT SECVNDVM", False) == 2
    assert at(P.detect_chapter, "CAPUT IX", False) == 9
    assert at(P.detect_controversy, "THE THIRD CONTROVERSY.", True) == 3
    assert at(P.detect_controversy, "nothing", False) is None


def test_headers(spark):
    meta = P.header_meta(F.array(F.lit("CAP. IV."), F.lit("33")), F.lit(3))
    got = spark.range(1).select(*[c.alias(k) for k, c in meta.items()]).head()
    assert (got.has_page, got.has_chapter, got.page_side, got.chapter_side, got.parity_ok) == (True, True, "right", "left", True)


def test_notes(spark):
    assert one(spark, P.clean_note_marks(F.col("t")), "a[b]? c[12]") == "a[fn-b] c[fn-12]"
    assert one(spark, P.relabel_notes(F.col("t")), "lead\n* first\nmore\n2. second") == "[fn01|?] lead\n[fn02|*] first more\n[fn03|2.] second"
    assert one(spark, P.relabel_notes(F.col("t")), None) == ""
    text = "a lower\na. no marker\n(b) nor this\n[ABC] three\nABCD four\n(12). twice closed\n†‡ signs\nX\n?! both"
    assert one(spark, P.relabel_notes(F.col("t")), text) == "[fn01|a] lower a. no marker (b) nor this\n[fn02|[ABC]] three ABCD four (12). twice closed\n[fn03|†‡] signs X\n[fn04|?!] both"
    assert one(spark, P.relabel_notes(F.col("t")), "0 zero\n1 one 1\n2. two 2\nmore 3") == "[fn01|0] zero\n[fn02|1] one 1\n[fn03|2.] two 2 more 3"


def test_digits_that_equal_the_place_of_their_line_stay(spark):
    assert one(spark, P.stitch_pages(F.array("t")), "year 0\nyear 1\nyear 2 \nend") == "year 0 year 1 year 2 end"
    assert one(spark, T.join_dehyphenate(F.split("t", "\n")), "0 a 0\n1 b 1\n2 c 2") == "0 a 0 1 b 1 2 c 2"


def test_report(spark):
    assert PP.report(spark.createDataFrame([(1, None)], "a int, b string"), "T") == "# T\n\n| a | b |\n| --- | --- |\n| 1 |  |\n"
    with pytest.raises(ValueError):
        PP.report(spark.range(5), "T", most=3)


def test_scores(spark):
    rows = spark.createDataFrame([(1, "a", "b", None), (2, " ", "b", "c"), (3, "a", None, "c")], "u int, s string, m string, r string")
    got = {r.u: (r.score, r.error) for r in PP.external_scores(rows, lambda s, m, r: [1.0] * len(s), "u", "s", "m", "r", reference_free=True).collect()}
    assert got == {1: (1.0, None), 2: (None, "missing_source"), 3: (None, "missing_translation")}
