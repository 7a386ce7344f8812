"""Text functions on literal rows: carets, OCR readings, numerals, Greek, headings, notes."""

import pytest
from pyspark.sql import functions as F

from folioframe.functions import pages as FP
from folioframe.functions import records as R
from folioframe.functions import text as T
from folioframe.operators import changes as C
from folioframe.plans import mining, validators

def values(c):
    return F.array_join(F.transform(F.array_sort(c), lambda v: v.cast("string")), " ")


def markers(c):
    m = FP.inline_markers(c)
    return F.concat_ws("|", m["text"], F.transform(m["markers"], lambda k: F.concat(k["symbol"], k["offset"].cast("string"))))


def marginal(c):
    m = FP.classify_marginal(c)
    return F.concat_ws(" ", m["kind"], m["citation"])


def joined(parts):
    return F.concat_ws("/", *[F.array_join(v, "") for v in parts.values()])


def at():
    return F.array(F.struct(F.lit(3).alias("offset"), F.lit("a").alias("symbol")), F.struct(F.lit(99).alias("offset"), F.lit("b").alias("symbol")))


def body_and_notes(c):
    n = T.split_body_notes(c)
    return F.concat_ws("/", n["body"], n["notes"])


CASES = {
    "ae": (lambda t: FP.normalize_ae(t), {"Przedixit prz": "Praedixit prae", "quse Ztern": "quae aetern", "terré": "terrae", "": "", None: None}),
    "open_c": (lambda t: FP.normalize_open_c(t), {"in CID, I2C": "in CIƆ, IƆC", "C1D; I2G": "CIƆ; IƆC", "CIDX": "CIDX", None: None}),
    "strip_carets": (lambda t: T.strip_carets(t), {"a^b c^de^9": "a c", "x ^ y": "x ^ y", "^a": "", None: None}),
    "markers": (lambda t: markers(t), {"Ister^k flumen^3 ibi": "Ister flumen ibi|k5|312", "none": "none", "": ""}),
    "inject": (lambda t: T.inject_markers(t, at()), {"abcdef": "abc^adef^b", "": "^a^b", None: None}),
    "links": (lambda t: T.caret_links(t), {"a^b": 'a<sup><a href="#fn-b">b</a></sup>', "plain": "plain"}),
    "catchword": (lambda t: T.normalize_catchword(t), {"“ſanctus,": "sanctus", "(Et)": "et", "—": "", "": ""}),
    "enclitic": (lambda t: F.array_join(T.split_enclitic(t), " "), {"gentesque": "gentes que", "atque": "atque", "que": "que", "gens": "gens"}),
    "loose_key": (lambda t: mining.loose_key(t, "ibus|orum|arum|ae|us|um|es"), {"episcopus ecclesiae": "episcop ecclesi", "reges regum": "reg reg", "et": "et"}),
    "roman": (lambda t: T.roman_to_int(t), {"XIV": 14, "IIX": 8, "MCMXC": 1990, "IIIIIV": None, "ABC": None, "": None, None: None}),
    "roman_strict": (lambda t: T.roman_to_int_strict(t), {"XIV": 14, "IIX": None, "mcmxc": 1990, "ABC": None, "": None}),
    "latin": (lambda t: values(F.transform(T.latin_numerals(t), lambda n: n["value"])), {"anno 36 octavum non XIV": "8 14 36", "nonus decem I": "9 10", "nihil unaé": ""}),
    "english": (lambda t: values(T.english_numerals(t, True)), {"the twenty-third of XX": "3 20 23", "7th ninetieth forty one": "1 7 40 41 90", "": ""}),
    "english_v2": (lambda t: values(T.english_numerals(t, False)), {"the twenty-third of XX": "20 23", "7th ninetieth forty one": "7 41 90", "": ""}),
    "forms": (lambda t: F.array_join(T.expected_forms(t.cast("int")), " "), {"8": "8 eight eighth VIII", "40": "40 forty fortieth XL", "23": "23 twenty-three twenty-third XXIII", "200": "200 CC", "5000": "5000"}),
    "greek": (lambda t: F.array_join(T.greek_spans(t), "|"), {"dixit λόγος et αβ": "λόγος", "ἀρχή, τέλος fin": "ἀρχή, τέλος", "none": ""}),
    "marginal": (lambda t: marginal(t), {"Gen. 1.1": "scripture Gen. 1:1", "1 Reg. 8.27": "scripture 1 Reg. 8:27", "Plinius": "unknown "}),
    "heading": (lambda t: FP.detect_chapter(t, t.startswith("CH")), {"CHAPTER XIV.": 14, "CAPVT SECVNDVM": 2, "CAPUT IX": 9, "text": None}),
    "printed_page": (lambda t: T.printed_page(t), {"12 CAP. III": "12", "De rebus 7": "7", "XIV": "xiv", "De rebus": None, "": None}),
    "notes": (lambda t: body_and_notes(t), {"body[FOOTNOTES]notes": "body/notes", "a[FOOTNOTES]b[FOOTNOTES]c": "a/b[FOOTNOTES]c", "body": "body"}),
    "note_marks": (lambda t: FP.clean_note_marks(t), {"a[b]? c[12]": "a[fn-b] c[fn-12]", "plain": "plain"}),
    "json": (lambda t: R.json_object_text(t), {'```json\n{"a": {"b": 1}}\n```': '{"a": {"b": 1}}', "no json": None, None: None}),
    "path": (lambda t: R.page_from_path(t), {"/a/p0012/p0034/f.json": "p0034", "/a/b.json": None}),
    "polish": (lambda t: joined(C.once_each(t, F.array(F.lit("a"), F.lit("b"), F.lit("d")))), {"x^a y^b y^b z^c": "d/b/c", "x ^a ^b ^d": "//", "": "abd//"}),
    "parity": (lambda t: joined(validators.marker_parity(F.regexp_extract_all(t, F.lit(r"\^([a-z])"), F.lit(1)), F.array(F.lit("x"), F.lit("z")))), {"a^x b^y": "y/z", "^x ^z": "/"}),
}


@pytest.mark.parametrize("name", CASES)
def test_literals(spark, name):
    column, cases = CASES[name]
    rows = spark.createDataFrame([(k,) for k in cases], "t string").select("t", column(F.col("t")).alias("x")).collect()
    assert {r.t: r.x for r in rows} == cases
