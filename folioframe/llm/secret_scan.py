"""Secret scan: candidates by pattern, false positives removed by a random forest.

A candidate is any value assigned to a word such as password or token, or to a name that holds one (SECRET_KEY), whatever blanks and
tabs stand around the sign, the password in an address (``//user:password@host``), a signed token with its dots, or a run of 16 and more letters, digits and ``_+/-``, or a shorter one that begins as issued keys do. The forest sees its length, shares and transitions of character
classes, how much of it dictionary words cover, whether it stands in a path, and the words beside it. It is trained from labelled
findings (left context, value, right context, label), a table or a list; where a user has none, from seeded examples of what is
and isn't a secret. :func:`evaluate` gives precision and recall on findings that were held out.

The dictionary is the most frequent whole words of a public tokenizer's vocabulary file, whose path is a parameter.

Native: candidates, features and the forest, written as a SQL expression, run in one stage without a shuffle.
"""

from __future__ import annotations

import base64
import random
import re
import string
from collections import Counter
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let

TREES, DEPTH, SEED, EXAMPLES = 21, 8, 5, 4000
#: Labelled findings that a forest is fitted on, at most (of the smallest hashes), and words of the dictionary.
FIT_FINDINGS, DICTIONARY_WORDS = 20_000, 1500
THRESHOLD, MASK = 0.5, "[SECRET]"
KEY = r"(?i:passwords?|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)"
#: The word may go on (SECRET_KEY, password-old); then the sign.
SIGN = r"[\w-]{0,40}+[\"']?[ \t]*+(?:=>|[=:])[ \t]*+[\"']?"
ASSIGNED = KEY + SIGN
#: What stands before a password in an address.
LOGIN = r"://[^\s:/@]{1,64}:"
LEAD = f"(?:{ASSIGNED}|{LOGIN})"
VALUE = r"[A-Za-z0-9_+/.!@#$%^&*~-]+"
#: Starts by which issuers mark their keys.
MARKS = r"(?:AKIA|ASIA|ghp_|gho_|ghs_|github_pat_|glpat-|xox[abprs]-|sk_live_|rk_live_|sk-|AIza|ya29|eyJ)"
ISSUED = f"^{MARKS}"
START = "(?<![A-Za-z0-9_+/-])"
#: Assigned values, passwords in addresses, signed tokens of several parts, issued keys, and runs that aren't themselves the name of an assignment.
PATTERN = "|".join([
    ASSIGNED + VALUE,
    LOGIN + r"[^\s/@]+(?=@)",
    START + r"eyJ[A-Za-z0-9_-]{8,}(?:\.[A-Za-z0-9_-]+){1,2}",
    START + MARKS + "[A-Za-z0-9_+/-]{12,}",
    START + rf"(?=[A-Za-z0-9_+/-]{{16}})(?![\w-]{{1,40}}?{KEY}{SIGN}{VALUE})[A-Za-z0-9_+/-]{{16,}}",
])
#: Endings and words that stand inside joined-up names, for values whose words nothing separates.
PARTS = "the|and|tion|ing|ment|with|from|have|this|that|user|name|file|data|page|test|demo|dummy|example|sample|change|place|holder|your|here|secret|password|token|hello|world|admin|letme|default|value|index|image|version|release|build|config|system|report|final|draft"
#: Words beside values that are digests or ids rather than secrets.
HARMLESS = r"(?i)\b(?:sha\d*|md5|commit|revision|checksum|digest|hash|etag|uuid|guid|isbn|order|invoice|phone|tel|card|account|version|build|serial|tracking|example|sample|placeholder|image|png|jpg)\b"
#: What documentation writes in place of a key.
PLACEHOLDER = r"(?i)example|sample|dummy|placeholder|change[_-]?me|your[_-]|redacted|xxxx|0000000|1234567|abcdef"
FEATURES = ("length", "digits", "upper", "lower", "hex", "changes", "distinct", "pairs", "longest", "mixed", "parts", "dictionary", "placeholder", "path", "assigned", "issued", "harmless", "dashes", "digits_only", "vowels")


def dictionary(path: str, words: int = DICTIONARY_WORDS, least: int = 4) -> tuple[str, ...]:
    """The first ``words`` whole lower-case words of a byte-level vocabulary (a piece and its rank a line), most frequent first."""
    found = []
    with open(path, "rb") as f:
        for line in f:
            piece = base64.b64decode(line.split()[0])
            if re.fullmatch(rb" [a-z]{%d,}" % least, piece):
                found.append(piece[1:].decode())
                if len(found) == words:
                    break
    return tuple(found)


def common_pairs(words: tuple[str, ...], pairs: int = 220) -> str:
    """A pattern that matches, without taking it, a letter pair frequent in ``words`` (or in :data:`PARTS`)."""
    count = Counter(w[i : i + 2] for w in words or PARTS.split("|") for i in range(len(w) - 1))
    after: dict[str, str] = {}
    for pair, _ in sorted(count.items(), key=lambda x: (-x[1], x[0]))[:pairs]:
        after[pair[0]] = after.get(pair[0], "") + pair[1]
    return "(?=" + "|".join(f"{a}[{b}]" for a, b in sorted(after.items())) + ")"


@dataclass(frozen=True)
class Model:
    """A grown forest and the dictionary that its features look words up in."""

    forest: list
    words: tuple[str, ...] = ()


def features(value: Column, left: Column, right: Column, words: tuple[str, ...] = ()) -> dict[str, Column]:
    """The forest's inputs; all are doubles."""
    size = F.greatest(F.length(value), F.lit(1)).cast("double")
    n = lambda p: F.regexp_count(value, F.lit(p)).cast("double")
    known = (lambda w: F.lower(w).isin(*words)) if words else (lambda w: F.lit(False))
    covered = F.aggregate(F.regexp_extract_all(value, F.lit("[A-Z]?[a-z]+|[A-Z]+"), F.lit(0)), F.lit(0), lambda a, w: a + F.when(known(w), F.length(w)).otherwise(0))
    segment = F.array_max(F.transform(F.split(value, "[/_.+-]+"), lambda s: F.struct(F.length(s).alias("n"), s.alias("s"))))
    change = "(?<=[a-z])[0-9A-Z]|(?<=[A-Z])[0-9a-z]|(?<=[0-9])[A-Za-z]"
    yes = lambda c: F.when(c, F.lit(1.0)).otherwise(F.lit(0.0))
    return {
        "length": size,
        "digits": n("[0-9]") / size,
        "upper": n("[A-Z]") / size,
        "lower": n("[a-z]") / size,
        "hex": yes(value.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")),
        "changes": n(change) / size,
        "distinct": F.size(F.array_distinct(F.split(value, ""))).cast("double") / size,
        "pairs": F.regexp_count(F.lower(value), F.lit(common_pairs(words))).cast("double") / size,
        "longest": segment["n"].cast("double"),
        "mixed": F.regexp_count(segment["s"], F.lit(change)).cast("double") / F.greatest(segment["n"], F.lit(1)),
        "parts": (size - F.length(F.regexp_replace(F.lower(value), PARTS, ""))) / size,
        "dictionary": covered / size,
        "placeholder": yes(value.rlike(PLACEHOLDER)),
        "path": yes(value.rlike("[/.][A-Za-z_]+[/.]|^/|/$") | (left.rlike(r"(?:https?:|/|\\)\S*$") & ~left.rlike(LOGIN + "$")) | right.rlike(r"^[./][A-Za-z]")),
        "assigned": yes(left.rlike(LEAD + "$")),
        "issued": yes(value.rlike(ISSUED)),
        "harmless": yes(left.rlike(HARMLESS) | right.rlike(HARMLESS)),
        "dashes": n("[_-]") / size,
        "digits_only": yes(value.rlike("^[0-9_+/-]+$")),
        "vowels": n("(?i)[aeiou]") / size,
    }


def labelled_examples(n: int = EXAMPLES, seed: int = SEED) -> list[tuple[str, str, str, int]]:
    """Seeded findings (left, value, right, label): issued keys, assigned random values and bare random runs against digests, ids, numbers, paths, names, words and placeholders."""
    r = random.Random(seed)
    pick = lambda chars, k: "".join(r.choice(chars) for _ in range(k))
    hexes, alnum, low = "0123456789abcdef", string.ascii_letters + string.digits, string.ascii_lowercase
    parts = PARTS.split("|")

    def word() -> str:
        """A word of syllables, a known one, or now and then letters at random."""
        kind = r.random()
        if kind < 0.15:
            return pick(low, r.randint(2, 9))
        if kind < 0.4:
            return r.choice(parts)
        return "".join(r.choice(["b", "c", "ch", "d", "f", "g", "h", "l", "m", "n", "p", "r", "s", "sch", "st", "t", "th", "tr", "v", "w"]) + r.choice(["a", "e", "i", "o", "u", "ea", "ie", "ou"]) + r.choice(["", "", "n", "r", "s", "t", "nd", "rt", "rtz", "ng"]) for _ in range(r.randint(1, 3)))

    prose = lambda: " ".join(word() for _ in range(r.randint(1, 4)))

    def secret() -> tuple[str, str]:
        key = r.choice(["password", "passwd", "secret", "token", "api_key", "apikey", "access_key", "TOKEN", "PASSWORD", "Secret"])
        sign = r.choice(["=", ": ", " = ", " = \"", "=\"", "='", ":", "\t= ", "   = ", "\t:\t", " =    "])
        kind = r.randrange(10)
        if kind in (0, 9):
            return prose() + " ", r.choice(["AKIA", "ASIA"]) + pick(string.ascii_uppercase + r.choice([string.digits, ""]), 16)
        if kind == 1:
            return r.choice([prose() + " ", f"{prose()} {key}{sign}"]), r.choice(["ghp_", "gho_", "glpat-", "sk_live_", "xoxb-", "AIza", "sk-"]) + pick(alnum, r.randint(20, 40))
        if kind in (2, 3):
            x = pick(r.choice([hexes, hexes, string.digits * 2 + "abcdef", string.digits * 6 + "abcdef"]), r.choice([16, 18, 20, 24, 32, 40, 64]))
            return f"{prose()} {key}{sign}", x.upper() if r.random() < 0.2 else x
        if kind == 6:
            x = list(pick(r.choice([alnum, string.ascii_letters + "!@#$%&*"]), r.randint(2, 6)) + r.choice(low) + r.choice(string.digits))
            r.shuffle(x)
            return f"{prose()} {key}{sign}", "".join(x)
        if kind in (7, 8):
            x = pick(r.choice([alnum, string.ascii_letters]), r.randint(20, 44))
            return prose() + " ", "".join(word() + r.choice("/_") for _ in range(r.choice([0, 0, 2, 12]))) + x
        return f"{prose()} {key}{sign}", pick(alnum + "_-+/" * (kind == 5), r.randint(10, 44))

    def harmless() -> tuple[str, str]:
        kind = r.randrange(15)
        if kind == 13:
            x = r.choice(["AKIA", "ASIA", "ghp_", "sk_live_", "AIza", "sk-"])
            return prose() + r.choice([" ", " key=", " token: "]), r.choice([x + pick(string.ascii_uppercase + string.digits, 9) + "EXAMPLE", x + "X" * 16, x + "EXAMPLE" + pick(alnum, 8), x + "your_key_goes_here", x + "1234567890abcdef"])
        if kind == 14:
            x = r.choice(["your_api_key_here", "change-me-please", "example-token-value", "REDACTED", "xxxxxxxxxxxx", "0000000000000000", "dummy_secret_1", "placeholder"])
            return f"{prose()} {r.choice(['password', 'token', 'secret', 'api_key'])}{r.choice(['=', ': ', ' = '])}", x
        if kind == 0:
            return f"{prose()} {r.choice(['commit', 'sha256', 'md5', 'checksum', 'digest', 'revision', 'etag'])}{r.choice([' ', ': ', '='])}", pick(hexes, r.choice([32, 40, 64]))
        if kind == 1:
            return prose() + " ", "-".join(pick(hexes, k) for k in (8, 4, 4, 4, 12))
        if kind == 2:
            return prose() + " ", pick(string.digits, r.randint(16, 24))
        if kind == 3:
            return prose() + " ", r.choice(["_", "-"]).join([*(word() for _ in range(r.randint(2, 5))), str(r.randint(0, 99))]).ljust(16, "a")
        if kind == 4:
            return prose() + r.choice([" https://", " /"]), "/".join([word() for _ in range(3)]) + "/" + str(r.randint(1, 9999)) + "/" + pick(hexes, 12)
        if kind == 5:
            return f"{prose()} {r.choice(['password', 'token', 'secret', 'api_key'])}{r.choice(['=', ': ', ' = '])}", (r.choice(parts) + r.choice(["", "_", "-"]) + r.choice(parts) + r.choice(["", "1", "123", "2024"])).ljust(8, "x")
        if kind == 6:
            return f"{prose()} {r.choice(['password', 'token', 'secret'])}{r.choice(['=', ': '])}", r.choice(["x", "*", "a", "0"]) * r.randint(8, 24)
        if kind == 7:
            return prose() + " ", word() + word() + word() + word() + str(r.randint(1, 2030))
        if kind == 8:
            return prose() + " ", "".join(word().capitalize() for _ in range(r.randint(3, 8))).ljust(16, "e")
        if kind == 9:
            x = "".join(r.choice(parts + [word()]) for _ in range(r.randint(3, 6))).ljust(16, "n")
            return prose() + " ", r.choice([x, x.capitalize(), x.upper()])
        if kind == 10:
            x = r.choice("/_-").join(word() for _ in range(r.randint(4, 20))).ljust(16, "a")
            return prose() + " ", x.upper() if r.random() < 0.3 else x
        if kind == 11:
            return f"{prose()} {r.choice(['token', 'secret', 'password', 'Password'])}{r.choice([': ', ' = ', '=', ':'])}", r.choice([word(), word() + r.choice(".!"), r.choice(parts), r.choice(["a", "-", "...", "***", "none", "null", "1", "20"])])
        return f"{prose()} {r.choice(['token', 'secret', 'password'])}: ", "".join(word() for _ in range(3)).ljust(8, "e")

    out = []
    for i in range(n):
        left, value = secret() if i % 2 else harmless()
        out.append((left, value, r.choice([" ", "\n", '" ', ". "]) + prose(), i % 2))
    return out


def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, seed: int = SEED) -> list:
    """Random forest: each tree is (feature, threshold, at most, above) or a leaf's share of label 1."""
    rng = np.random.default_rng(seed)
    tried = max(1, int(np.sqrt(x.shape[1]) + 1))

    def node(rows: np.ndarray, left: int):
        share = float(y[rows].mean())
        if not left or share in (0.0, 1.0) or len(rows) < 4:
            return share
        best = None
        for f in rng.choice(x.shape[1], tried, replace=False):
            v = np.unique(x[rows, f])
            for t in v[:-1][:: max(1, len(v) // 24)]:
                low = x[rows, f] <= t
                a, b = y[rows[low]], y[rows[~low]]
                cost = len(a) * a.mean() * (1 - a.mean()) + len(b) * b.mean() * (1 - b.mean())
                if best is None or cost < best[0]:
                    best = (cost, int(f), float(t), low)
        if best is None:
            return share
        _, f, t, low = best
        return (f, t, node(rows[low], left - 1), node(rows[~low], left - 1))

    return [node(rng.integers(0, len(y), len(y)), depth) for _ in range(trees)]


def forest_score(forest: list, inputs: dict[str, Column]) -> Column:
    names = list(inputs)

    def tree(t) -> Column:
        return F.lit(t) if isinstance(t, float) else F.when(inputs[names[t[0]]] <= F.lit(t[1]), tree(t[2])).otherwise(tree(t[3]))

    return reduce(lambda a, b: a + b, map(tree, forest)) / F.lit(float(len(forest)))


def _findings(spark: SparkSession, findings) -> DataFrame:
    if findings is None:
        findings = labelled_examples()
    return findings if isinstance(findings, DataFrame) else spark.createDataFrame(findings, "left string, value string, right string, label int")


def train(spark: SparkSession, findings: DataFrame | list[tuple[str, str, str, int]] | None = None, words: tuple[str, ...] = (), most: int = FIT_FINDINGS, **options) -> Model:
    """A model from labelled findings (left, value, right, label); of more than ``most`` those of the smallest hashes are taken.

    Findings with a null value or label are left out; null contexts count as empty.
    """
    rows = _findings(spark, findings).where("value is not null and label is not null")
    rows = rows.orderBy(F.xxhash64("left", "value", "right"), "value").limit(most)
    side = lambda c: F.coalesce(F.col(c), F.lit(""))
    got = rows.select(*[c.alias(k) for k, c in features(F.col("value"), side("left"), side("right"), words).items()], "label").collect()
    data = np.array([tuple(map(float, r)) for r in got])
    return Model(grow(data[:, :-1], data[:, -1], **options), words)


def evaluate(spark: SparkSession, model: Model, findings: DataFrame | list[tuple[str, str, str, int]], threshold: float = THRESHOLD) -> dict[str, float]:
    """Precision and recall of the model on labelled findings that it wasn't trained on."""
    x = _findings(spark, findings).withColumn("_f", F.struct(*[c.alias(k) for k, c in features(F.col("value"), F.col("left"), F.col("right"), model.words).items()]))
    hit = let(F.col("_f"), lambda f: forest_score(model.forest, {k: f[k] for k in FEATURES})) >= threshold
    both, said, true = x.agg(F.count(F.when(hit & (F.col("label") == 1), 1)), F.count(F.when(hit, 1)), F.count(F.when(F.col("label") == 1, 1))).head()
    return {"precision": both / max(said, 1), "recall": both / max(true, 1)}


def _candidates(text: Column, model: Model) -> Column:
    """Array of (gap, key, value, p) in text order: what stands before, the assignment's word and sign, the value, its score."""
    gaps, found = F.split(text, PATTERN, -1), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))

    def one(parts: Column, m: Column, i: Column) -> Column:
        key = F.regexp_extract(m, f"^{LEAD}", 0)
        value = F.substring(m, F.length(key) + 1, F.length(m))
        left = F.concat(F.right(F.get(parts, i), F.lit(40)), key)
        inputs = let(
            F.struct(value.alias("value"), left.alias("left"), F.left(F.get(parts, i + 1), F.lit(24)).alias("right")),
            lambda c: let(F.struct(*[v.alias(k) for k, v in features(c["value"], c["left"], c["right"], model.words).items()]), lambda f: forest_score(model.forest, {k: f[k] for k in FEATURES})),
        )
        return F.struct(F.get(parts, i).alias("gap"), key.alias("key"), value.alias("value"), inputs.alias("p"))

    return let(gaps, lambda parts: F.transform(found, lambda m, i: one(parts, m, i)))


def scan(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """A row for each secret: id, start (characters before it), length, kind (issued, assigned or run), score, secret.

    A null or empty text has none; texts and candidates of any length are looked at whole; repeated rows each give theirs, a null
    id stays null; an empty table gives no rows; other columns aren't read.
    """
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    c = docs.select(docs[id_col].alias("_id"), text.alias("_t")).where(F.col("_t").rlike(PATTERN)).select("_id", _candidates(F.col("_t"), model).alias("_c"))
    empty = F.array().cast("array<struct<start:bigint,value:string,key:string,p:double>>")

    def step(a: Column, x: Column) -> Column:
        start = a["at"] + F.length(x["gap"]) + F.length(x["key"])
        row = F.struct(start.alias("start"), x["value"].alias("value"), x["key"].alias("key"), x["p"].alias("p"))
        return F.struct((start + F.length(x["value"])).alias("at"), F.when(x["p"] >= threshold, F.concat(a["out"], F.array(row))).otherwise(a["out"]).alias("out"))

    found = F.aggregate(F.col("_c"), F.struct(F.lit(0).cast("long").alias("at"), empty.alias("out")), step, lambda a: a["out"])
    rows = c.select("_id", F.explode(found).alias("f"))
    kind = F.when(F.col("f.value").rlike(ISSUED), "issued").when(F.col("f.key") != "", "assigned").otherwise("run")
    return rows.select(F.col("_id").alias(id_col), F.col("f.start").alias("start"), F.length("f.value").cast("long").alias("length"), kind.alias("kind"), F.col("f.p").alias("score"), F.col("f.value").alias("secret"))


def redact(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD, mask: str = MASK) -> DataFrame:
    """``docs`` with each secret of ``text_col`` replaced by ``mask``; all rows and other columns stay, null texts too."""
    text = docs[text_col].cast("string")
    tail = lambda parts: F.element_at(parts, -1)
    piece = lambda x: F.concat(x["gap"], x["key"], F.when(x["p"] >= threshold, F.lit(mask)).otherwise(x["value"]))
    clean = F.concat(F.concat_ws("", F.transform(_candidates(text, model), piece)), tail(F.split(text, PATTERN, -1)))
    return docs.withColumn(text_col, F.when(text.rlike(PATTERN), clean).otherwise(text))
