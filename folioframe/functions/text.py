"""Column functions over text: cleaning, numerals, tokens, scripts, and comparisons."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

CARET = r"\^[A-Za-z0-9]{1,2}"
CARET_LETTER = r"\^([a-z])\b"
GREEK = r"[\x{0370}-\x{03FF}\x{1F00}-\x{1FFF}]"
#: Latin ordinal stems and their endings, cardinals, and English number words.
ORDINAL_ENDINGS = "us|a|um|i|o|ae|orum|arum|is|em|os|as|ius"
LATIN_ORDINALS = {"prim": 1, "secund": 2, "terti": 3, "quart": 4, "quint": 5, "sext": 6, "septim": 7, "octav": 8, "non": 9, "decim": 10, "undecim": 11, "duodecim": 12}
LATIN_CARDINALS = {
    1: "unus una unum unius uni uno", 2: "duo duae duos duarum duobus duabus", 3: "tres tria trium tribus", 4: "quattuor quatuor", 5: "quinque", 6: "sex", 7: "septem", 8: "octo", 9: "novem", 10: "decem",
    11: "undecim", 12: "duodecim", 13: "tredecim", 14: "quattuordecim", 15: "quindecim", 16: "sedecim", 17: "septendecim", 18: "duodeviginti", 19: "undeviginti", 20: "viginti", 30: "triginta", 40: "quadraginta",
    50: "quinquaginta", 60: "sexaginta", 70: "septuaginta", 80: "octoginta", 90: "nonaginta", 100: "centum", 1000: "mille",
}
ONES = "one two three four five six seven eight nine".split()
TEENS = "ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split()
TENS = "twenty thirty forty fifty sixty seventy eighty ninety".split()
ORDINAL_ONES = "first second third fourth fifth sixth seventh eighth ninth".split()
ORDINAL_TEENS = "tenth eleventh twelfth thirteenth fourteenth fifteenth sixteenth seventeenth eighteenth nineteenth".split()
ORDINAL_TENS = "twentieth thirtieth fortieth fiftieth sixtieth seventieth eightieth ninetieth".split()
WORD_VALUE = {w: i + 1 for words in (ONES, ORDINAL_ONES) for i, w in enumerate(words)} | {w: i + 10 for words in (TEENS, ORDINAL_TEENS) for i, w in enumerate(words)} | {w: 10 * (i + 2) for words in (TENS, ORDINAL_TENS) for i, w in enumerate(words)}


def compose(*steps):
    """A column function that applies the steps in order."""
    return lambda c: reduce(lambda x, f: f(x), steps, c)


def normalize_ligatures(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, "[ÆǢ]", "AE"), "[æǣ]", "ae")


def normalize_ws(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def strip_carets(c: Column, pattern: str = CARET) -> Column:
    return F.regexp_replace(c, pattern, "")


def excerpt(c: Column, size: int = 160) -> Column:
    x = normalize_ws(c)
    return F.when(F.length(x) > size, F.concat(F.left(x, F.lit(size)), F.lit("…"))).otherwise(x)


def clip_around(c: Column, start: Column, end: Column, reach: int = 24) -> Column:
    """Text [start, end) with ``reach`` characters on both sides, and an ellipsis where more was cut."""
    lo, hi = F.greatest(start - reach, F.lit(0)), F.least(end + reach, F.length(c))
    return F.concat(F.when(lo > 0, "…").otherwise(""), F.substring(c, lo + 1, hi - lo), F.when(hi < F.length(c), "…").otherwise(""))


def first_token(c: Column) -> Column:
    """First word without punctuation or symbols at its ends; '' for a blank text."""
    word = F.coalesce(F.try_element_at(F.split(F.trim(F.regexp_replace(c, r"\s+", " ")), " "), F.lit(1)), F.lit(""))
    return F.regexp_replace(word, r"^[\p{P}\p{S}]+|[\p{P}\p{S}]+$", "")


def last_token(c: Column) -> Column:
    word = F.coalesce(F.try_element_at(F.split(F.trim(F.regexp_replace(c, r"\s+", " ")), " "), F.lit(-1)), F.lit(""))
    return F.regexp_replace(word, r"^[\p{P}\p{S}]+|[\p{P}\p{S}]+$", "")


def normalize_catchword(c: Column) -> Column:
    return F.regexp_replace(F.replace(F.lower(c), F.lit("ſ"), F.lit("s")), r"^[\p{P}\p{S}\s]+|[\p{P}\p{S}\s]+$", "")


def join_dehyphenate(lines: Column, hyphens: str = "-¬—­") -> Column:
    """Lines joined by spaces; one that ends with a hyphen loses it and is fused with the next."""
    marks = "".join("\\" + h if h in "-]^\\" else h for h in hyphens)
    return F.trim(F.regexp_replace(F.regexp_replace(F.array_join(F.transform(lines, lambda x: F.trim(x)), "\n"), rf"[{marks}]\n", ""), "\n", " "))


def alpha_breakdown(c: Column) -> dict[str, Column]:
    """Counts of Latin, Greek and other letters."""
    n = lambda p: F.regexp_count(c, F.lit(p))
    return {"latin": n(r"\p{IsLatin}"), "greek": n(rf"(?=\p{{L}}){GREEK}"), "other": n(rf"(?=\p{{L}})(?!{GREEK})[^\p{{IsLatin}}]")}


def greek_spans(c: Column, least: int = 3) -> Column:
    """Runs of Greek letters with blanks, commas and quotes between, that hold ``least`` Greek letters or more."""
    runs = F.regexp_extract_all(c, F.lit(rf"{GREEK}(?:[{GREEK[1:-1]} ,'’ʼ]*{GREEK})?"), F.lit(0))
    return F.filter(runs, lambda x: F.regexp_count(x, F.lit(GREEK)) >= least)


def char_diff_rate(a: Column, b: Column) -> Column:
    """Share of unequal characters, place by place, of the longer text, in per cent; 0 for two empty texts."""
    n = F.greatest(F.length(a), F.length(b))
    same = F.aggregate(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: (x.eqNullSafe(y) & x.isNotNull()).cast("int")), F.lit(0), lambda s, x: s + x)
    return F.when(n == 0, 0.0).otherwise(100.0 * (n - F.when((F.length(a) == 0) | (F.length(b) == 0), 0).otherwise(same)) / n)


def content_words(c: Column, stopwords: list[str], least: int = 3) -> Column:
    """Distinct lower-case words of ``least`` letters or more that aren't stopwords, in order."""
    words = F.regexp_extract_all(F.lower(c), F.lit(rf"\p{{L}}{{{least},}}"), F.lit(0))
    return F.array_except(words, F.array(*map(F.lit, stopwords)).cast("array<string>"))


def jaccard(a: Column, b: Column) -> Column:
    both, either = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(either == 0, 0.0).otherwise(both / either)


def balanced_similarity(a: Column, b: Column, len_a: Column, len_b: Column) -> Column:
    """Jaccard of word sets, scaled by 0.5 + 0.5 * (shorter / longer length)."""
    longer = F.greatest(len_a, len_b)
    return jaccard(a, b) * (0.5 + 0.5 * F.when(longer == 0, 0.0).otherwise(F.least(len_a, len_b) / longer))


_ROMAN = {"I": 1, "V": 5, "X": 10, "L": 50, "C": 100, "D": 500, "M": 1000}


def roman_to_int(c: Column) -> Column:
    """Subtractive sum from the right, permissive about order; null for anything but the seven letters."""
    value = lambda x: reduce(lambda a, kv: a.when(x == kv[0], kv[1]), list(_ROMAN.items())[1:], F.when(x == "I", 1))
    step = lambda a, x: F.struct((a["t"] + F.when(x < a["p"], -x).otherwise(x)).alias("t"), F.greatest(a["p"], x).alias("p"))
    total = F.aggregate(F.transform(F.reverse(F.split(c, "")), value), F.struct(F.lit(0).alias("t"), F.lit(0).alias("p")), step, lambda a: a["t"])
    return F.when(c.rlike("^[IVXLCDM]+$") & (total > 0), total)


def int_to_roman(n: Column) -> Column:
    """1 to 3999; null outside."""
    place = lambda one, five, ten: ["", one, one * 2, one * 3, one + five, five, five + one, five + one * 2, five + one * 3, one + ten]
    digit = lambda table, d: F.element_at(F.array(*map(F.lit, table)), (d % 10 + 1).cast("int"))
    parts = [digit(["", "M", "MM", "MMM", *[""] * 6], F.floor(n / 1000)), digit(place("C", "D", "M"), F.floor(n / 100)), digit(place("X", "L", "C"), F.floor(n / 10)), digit(place("I", "V", "X"), n)]
    return F.when(n.between(1, 3999), F.concat(*parts))


def roman_to_int_strict(c: Column) -> Column:
    """As :func:`roman_to_int`, but only for the canonical spelling."""
    n = roman_to_int(F.upper(c))
    return F.when(int_to_roman(n) == F.upper(c), n)


def _lookup(table: dict[str, int], key: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[key]


def latin_numerals(c: Column) -> Column:
    """Array of (value, token) of digits, upper-case Roman numerals of two letters or more, ordinals and cardinals."""
    pair = lambda value: lambda t: F.struct(value(t).cast("int").alias("value"), t.alias("token"))
    found = lambda p, g=0: F.regexp_extract_all(c, F.lit(p), F.lit(g))
    stems = "|".join(sorted(LATIN_ORDINALS, key=len, reverse=True))
    cardinals = {w: v for v, words in LATIN_CARDINALS.items() for w in words.split()}
    names = "|".join(sorted(cardinals, key=len, reverse=True))
    return F.concat(
        F.transform(found(r"(?U)\b[0-9]{1,9}"), pair(lambda t: t)),
        F.transform(found(r"(?U)\b[IVXLCDM]{2,}\b"), pair(roman_to_int)),
        F.transform(found(rf"(?iU)\b(?:{stems})(?:{ORDINAL_ENDINGS})\b"), pair(lambda t: _lookup(LATIN_ORDINALS, F.regexp_extract(F.lower(t), rf"^({stems})(?:{ORDINAL_ENDINGS})$", 1)))),
        F.transform(found(rf"(?iU)\b(?:{names})\b"), pair(lambda t: _lookup(cardinals, F.lower(t)))),
    )


def english_numerals(c: Column, compound_parts: bool = True) -> Column:
    """Distinct values of digits, Roman numerals and number words; a compound gives its sum, and its parts unless switched off."""
    found = lambda x, p, g=0: F.regexp_extract_all(x, F.lit(p), F.lit(g))
    tens, ones = "|".join(TENS), "|".join([*ORDINAL_ONES, *ONES])
    compound = rf"(?iU)\b(?:{tens})[-\s](?:{ones})\b"
    parts = lambda t: F.transform(F.regexp_extract_all(F.lower(t), F.lit("[a-z]+"), F.lit(0)), lambda w: _lookup(WORD_VALUE, w))
    total = lambda p: F.aggregate(p, F.lit(0), lambda a, x: a + x)
    compounds = F.flatten(F.transform(found(c, compound), lambda t: F.concat(F.array(total(parts(t))), parts(t)) if compound_parts else F.array(total(parts(t)))))
    rest = F.regexp_replace(c, compound, " ")
    single = F.transform(found(rest, rf"(?iU)\b(?:{'|'.join(sorted(WORD_VALUE, key=len, reverse=True))})\b"), lambda t: _lookup(WORD_VALUE, F.lower(t)))
    digits = F.transform(found(c, r"(?U)\b[0-9]{1,9}"), lambda t: t.cast("int"))
    romans = F.transform(found(c, r"(?U)\b[IVXLCDM]{2,}\b"), roman_to_int)
    return F.array_distinct(F.concat(digits, romans, compounds, single))


def expected_forms(n: Column) -> Column:
    """Ways to write a value in English: digits, cardinal, ordinal (to 99) and Roman numeral."""
    cardinal, ordinal = {i + 1: w for i, w in enumerate(ONES)}, {i + 1: w for i, w in enumerate(ORDINAL_ONES)}
    cardinal |= {i + 10: w for i, w in enumerate(TEENS)} | {10 * (i + 2): w for i, w in enumerate(TENS)}
    ordinal |= {i + 10: w for i, w in enumerate(ORDINAL_TEENS)} | {10 * (i + 2): w for i, w in enumerate(ORDINAL_TENS)}
    for v in range(21, 100):
        if v % 10:
            cardinal[v], ordinal[v] = f"{cardinal[v - v % 10]}-{cardinal[v % 10]}", f"{cardinal[v - v % 10]}-{ordinal[v % 10]}"
    name = lambda t: F.create_map(*[F.lit(x) for kv in t.items() for x in kv])[n.cast("int")]
    return F.array_compact(F.array(n.cast("string"), name(cardinal), name(ordinal), int_to_roman(n)))


def split_enclitic(token: Column, enclitic: str = "que", exceptions: tuple[str, ...] = ("atque", "neque", "quoque", "usque", "itaque", "denique", "namque", "undique", "absque", "quisque", "utique")) -> Column:
    """['stem', 'que'] for a word that carries the enclitic, ['word'] otherwise."""
    cut = token.endswith(enclitic) & ~token.isin(*exceptions) & (F.length(token) > len(enclitic) + 1)
    return F.when(cut, F.array(F.substring(token, F.lit(1), F.length(token) - len(enclitic)), F.lit(enclitic))).otherwise(F.array(token))


def gram(tokens: Column, first: Column, n: int) -> Column:
    """The n-gram at a 0-based place, joined by spaces; by single elements, since a slice inside a lambda copies the whole array."""
    return F.concat_ws(" ", *[F.get(tokens, first + k) for k in range(n)])


def ngrams(tokens: Column, least: int = 2, most: int = 6) -> Column:
    """All n-grams of an array, joined by spaces, n from ``least`` to ``most``; the array is evaluated once a row, not once an n-gram."""
    none = F.array().cast("array<string>")

    def grams(t: Column) -> Column:
        sized = lambda n: F.when(F.size(t) >= n, F.transform(F.sequence(F.lit(0), F.size(t) - n), lambda i: gram(t, i, n))).otherwise(none)
        return F.concat(*[sized(n) for n in range(least, most + 1)])

    return F.element_at(F.transform(F.array(tokens), grams), 1)


def log_likelihood(k11: Column, row: Column, col: Column, total: Column) -> Column:
    """Dunning's G2 of a 2x2 table from a pair's count, its marginals and the total; cells are clamped at 0."""
    a = k11.cast("double")
    b, c = F.greatest(row - k11, F.lit(0)).cast("double"), F.greatest(col - k11, F.lit(0)).cast("double")
    d = F.greatest(total - row - col + k11, F.lit(0)).cast("double")
    n = a + b + c + d
    part = lambda o, r, k: F.when(o > 0, o * F.ln(o * n / (r * k))).otherwise(0.0)
    return 2.0 * (part(a, a + b, a + c) + part(b, a + b, b + d) + part(c, c + d, a + c) + part(d, c + d, b + d))


def sentence_ends(line: Column, abbreviations: tuple[str, ...] = ("cap", "lib", "pag", "ver", "tom", "edit", "epist", "part", "op", "num", "vid", "etc", "seq", "ibid", "fol", "sect", "art")) -> Column:
    """Whether a line ends a sentence: terminal mark (quotes may follow), and its last word is no initial, Roman numeral or abbreviation."""
    x = F.regexp_replace(F.rtrim(line), "[\"'”’»)\\]]+$", "")
    word = F.regexp_extract(x, r"(?U)(\w+)\.$", 1)
    soft = (F.length(word) == 1) | word.rlike("^[IVXLCDMivxlcdm]+$") | F.lower(word).isin(*abbreviations)
    return F.coalesce(x.rlike("[!?]$") | (x.endswith(".") & ~((word != "") & soft)), F.lit(False))


def split_body_notes(c: Column, mark: str = "[FOOTNOTES]") -> Column:
    """(body, notes) around the first mark; notes null without it."""
    at = F.instr(c, mark)
    return F.struct(F.when(at > 0, F.substring(c, F.lit(1), at - 1)).otherwise(c).alias("body"), F.when(at > 0, F.substring(c, at + len(mark), F.length(c))).alias("notes"))


def printed_page(c: Column) -> Column:
    """Arabic number at the start or end of a header, else a header that is all Roman numeral, in lower case."""
    arabic = F.coalesce(F.nullif(F.regexp_extract(c, r"^\s*([0-9]{1,4})\b", 1), F.lit("")), F.nullif(F.regexp_extract(c, r"\b([0-9]{1,4})\s*$", 1), F.lit("")))
    return F.coalesce(arabic, F.when(F.trim(c).rlike("^(?i)[ivxlcdm]+$"), F.lower(F.trim(c))))


def inject_markers(text: Column, markers: Column) -> Column:
    """Insert ``^symbol`` at the character offsets of an array of (offset, symbol), from the right, clamped to the text."""
    put = lambda t, m: F.overlay(t, F.concat(F.lit("^"), m["symbol"]), F.least(m["offset"], F.length(text)) + 1, F.lit(0))
    return F.aggregate(F.reverse(F.array_sort(markers)), text, put)


def caret_links(c: Column) -> Column:
    """``^X`` as superscript links."""
    return F.regexp_replace(c, r"\^([A-Za-z0-9*†‡§])", '<sup><a href="#fn-$1">$1</a></sup>')


def script_kind(text: Column, source: Column) -> Column:
    """EMPTY, PUNCT_ONLY, GREEK_ONLY or LATIN_VERBATIM, the first that holds; null for a real translation.

    The punctuation set reaches from U+0021 to U+003F and so holds digits.
    """
    letters = alpha_breakdown(text)
    folded = lambda x: F.lower(normalize_ws(x))
    return (
        F.when(F.coalesce(normalize_ws(text), F.lit("")) == "", "EMPTY")
        .when(text.rlike(r"^[\s!-?—–‒―•·…“”‘’„‚«»()\[\]{}<>\-]*$"), "PUNCT_ONLY")
        .when((letters["greek"] > 0) & (letters["latin"] == 0) & (letters["other"] == 0), "GREEK_ONLY")
        .when(folded(text) == folded(source), "LATIN_VERBATIM")
    )
