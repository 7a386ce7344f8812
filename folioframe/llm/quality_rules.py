"""Quality rules by weak supervision.

Each rule votes for, votes against or abstains on a document. Expectation-maximisation over the counts of vote
patterns estimates how often each rule gives each vote on good and on bad documents, without any label; the posterior
probability of "good" then decides, in place of a filter that every rule must pass.

Native: features, votes and posterior are SQL expressions. Features are computed once and stored in the shared
folder; the driver sees only the counts of vote patterns, at most 3 to the power of the number of rules.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, stored, unused, words

ABSTAIN, FOR, AGAINST = 0, 1, 2
#: A word of letters, small but for the first, with one closing mark at most.
CLEAN_WORD = r"(?<![^\x20\x09-\x0D])\p{L}\p{Ll}*+[.,;:?]?(?![^\x20\x09-\x0D])"
#: Share of repeated words that counts against any text, and words more that may repeat: one sentence said twice is a large share of a short text.
REPEATED, SAID_TWICE = 0.33, 14
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_shouts", "n_clean")


def repeat_words(w: Column, n: int = 3) -> Column:
    """Words of ``w`` that lie in an n-word window found twice or more, the first one included.

    Windows are held as 64-bit hashes beside their positions and sorted, so equal ones are neighbours; a false match
    inside one text of a million words has a chance of 3e-8.
    """
    last = F.size(w) - n
    window = lambda i: F.struct(F.xxhash64(*[F.get(w, i + k) for k in range(n)]).alias("h"), i.alias("p"))
    ordered = F.sort_array(F.transform(F.sequence(F.lit(0), last), window))

    def places(s: Column) -> Column:
        same = lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))
        return F.sort_array(F.transform(F.filter(s, lambda x, i: F.coalesce(same(x, i), F.get(s, i + 1)["h"] == x["h"], F.lit(False))), lambda x: x["p"]))

    covered = lambda p: F.aggregate(
        p,
        F.struct(F.lit(0).alias("c"), F.lit(-1).alias("e")),
        lambda a, x: F.struct((a["c"] + F.least(F.lit(n), x + (n - 1) - a["e"])).alias("c"), (x + (n - 1)).alias("e")),
        lambda a: a["c"],
    )
    return F.when(last < 1, F.lit(0)).otherwise(let(ordered, lambda s: let(places(s), covered))).cast("long")


def text_features(text: Column) -> dict[str, Column]:
    """The base columns of the contract and what else the rules look at; null texts count as empty."""
    text = F.coalesce(text, F.lit(""))
    w = F.col("_words")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return {
        "n_words": F.size(w).cast("long"),
        "word_chars": F.length(F.concat_ws("", w)).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": repeat_words(w),
        "n_upper": F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long"),
        "n_shouts": F.regexp_count(text, F.lit("!")).cast("long"),
        "n_clean": F.regexp_count(text, F.lit(CLEAN_WORD)).cast("long"),
    }


def default_rules() -> dict[str, Column]:
    """Name -> vote, over the feature columns. Shares are per word (capitals: per character of words).

    Most rules look for one kind of damage and abstain where they don't find it; a document without words gets
    abstentions only.
    """
    n, chars = F.nullif(F.col("n_words"), F.lit(0)), F.nullif(F.col("word_chars"), F.lit(0))

    def against(value: Column, bad: Column, good: Column | None = None) -> Column:
        return F.when(value.isNull(), F.lit(ABSTAIN)).when(bad, F.lit(AGAINST)).when(F.lit(False) if good is None else good, F.lit(FOR)).otherwise(F.lit(ABSTAIN))

    clean, length, repeats = F.col("n_clean") / n, F.col("word_chars") / n, F.col("n_repeat_words") / n
    return {
        "symbols": against(n, F.col("n_symbols") / n > 0.12),
        "repeats": against(n, repeats > REPEATED + SAID_TWICE / n, repeats < 0.10),
        "lines": against(n, F.col("n_dup_lines") / n > 0.05),
        "word_length": against(n, (length < 2.5) | (length > 12.0)),
        "upper": against(chars, F.col("n_upper") / chars > 0.30),
        "shouts": against(n, F.col("n_shouts") / n > 0.15),
        "clean_words": against(n, clean < 0.60, clean > 0.85),
    }


def fit_votes(counts: dict[tuple[int, ...], int], rules: int, rounds: int = 100, prior_good: float = 0.8, strength: float = 20.0) -> tuple[float, list[list[tuple[float, float]]]]:
    """Expectation-maximisation over pattern counts -> log prior odds and (P(vote | good), P(vote | bad)) per rule and vote.

    Starts from "bad if any rule votes against", which ties the classes to their names. Pseudo-counts of ``strength``
    keep rules that rarely vote, and tables with one kind of document only, in place; rules are taken to be better
    than chance (a vote never counts for the other side) and abstaining says nothing.
    """
    total = sum(counts.values())
    given = {ABSTAIN: (0.7, 0.7), FOR: (0.29, 0.15), AGAINST: (0.01, 0.15)}
    post = {v: 0.1 if AGAINST in v else 0.9 for v in counts}
    odds, table = math.log(prior_good / (1 - prior_good)), [[given[v] for v in (ABSTAIN, FOR, AGAINST)] for _ in range(rules)]
    for _ in range(rounds if total else 0):
        good = sum(n * post[v] for v, n in counts.items())
        share = (good + strength * prior_good) / (total + strength)
        odds = math.log(share / (1 - share))
        for j in range(rules):
            for vote in (FOR, AGAINST):
                seen = [sum(n * w(post[v]) for v, n in counts.items() if v[j] == vote) for w in (lambda p: p, lambda p: 1 - p)]
                g, b = ((strength * given[vote][c] + seen[c]) / (strength + (good, total - good)[c]) for c in (0, 1))
                table[j][vote] = (max(g, b), b) if vote == FOR else (g, max(g, b))
            table[j][ABSTAIN] = (1.0, 1.0)
        logit = {v: odds + sum(math.log(table[j][x][0] / table[j][x][1]) for j, x in enumerate(v)) for v in counts}
        new = {v: 1 / (1 + math.exp(-max(-60.0, min(60.0, z)))) for v, z in logit.items()}
        moved = max(abs(new[v] - post[v]) for v in counts)
        post = new
        if moved < 1e-9:
            break
    return odds, table


def judge(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None, rules: Callable[[], dict[str, Column]] = default_rules, threshold: float = 0.5) -> DataFrame:
    """Features, base rule, vote of each rule (``vote_``), ``p_good`` and ``kept`` for every row.

    ``keep`` names the columns of ``docs`` to carry (all by default); one that clashes with a column made here gives
    way to it. A null, empty or blank text has no words: base_failed is true, so it isn't kept. Equal texts get equal
    verdicts, so repeated rows each get theirs; null ids are carried as they are; texts of any length are read whole, one text's
    words being held at a time; an empty table gives no rows.
    """
    made = {*FEATURES, "_text", "_words", "base_failed", "p_good", "kept", *(f"vote_{k}" for k in rules())}
    carried = [c for c in (docs.columns if keep is None else keep) if c not in made]
    text = docs[text_col].cast("string")
    base = docs.select(*[docs[c] for c in carried], text.alias("_text"), words(text).alias("_words"))
    feats = base.select(*carried, *[c.alias(k) for k, c in text_features(F.col("_text")).items()])
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    feats = stored(feats.select("*", failed.alias("base_failed"), *[v.alias(f"vote_{k}") for k, v in rules().items()]), "quality-features")
    names = [f"vote_{k}" for k in rules()]
    counts = {tuple(r[:-1]): r[-1] for r in feats.groupBy(*names).count().collect()}
    odds, table = fit_votes(counts, len(names))
    z = F.lit(odds)
    for name, votes in zip(names, table, strict=True):
        part = F.lit(0.0)
        for v, (g, b) in zip((ABSTAIN, FOR, AGAINST), votes, strict=True):
            part = F.when(F.col(name) == v, F.lit(math.log(g / b))).otherwise(part)
        z = z + part
    p = 1 / (1 + F.exp(-z))
    return feats.select("*", p.alias("p_good")).select("*", (~F.col("base_failed") & (F.col("p_good") >= threshold)).alias("kept"))


def filter_documents(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns and types.

    Only verdicts are stored: rows find theirs by id and hash of the text, so copies of a text spread over the tasks. Repeated
    rows, null ids, null and long texts and columns of any name or type stay as they are.
    """
    k, th = unused(docs.columns, "id"), unused(docs.columns, "th")
    keys = {k: F.coalesce(docs[id_col].cast("string"), F.lit("")), th: F.xxhash64(F.coalesce(docs[text_col].cast("string"), F.lit("")))}
    kept = judge(docs.select(*[c.alias(n) for n, c in keys.items()], docs[text_col].alias("text")), "text", keep=[k, th]).where("kept").select(k, th).distinct()
    return docs.withColumns(keys).join(kept, [k, th], "left_semi").select(*docs.columns)
