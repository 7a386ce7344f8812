"""Greek findings over all segments, against plain Python."""

import collections
import re
import unicodedata

from folioframe import queries as Q

GREEK = "\u0370-\u03ff\u1f00-\u1fff"
CUES = r"\b(hoc\s+est|id\s+est|nempe|videlicet|scilicet|vel|seu|sive|h\.\s*e\.|i\.\s*e\.|viz\.|sc\.)\b"


def plain(text):
    return "".join(c for c in unicodedata.normalize("NFD", text) if not unicodedata.combining(c))


def replaced(text, pairs):
    for a, b in pairs:
        text = text.replace(a, b)
    return text


def test_greek_of_all_segments(spark, small):
    talks = collections.defaultdict(list)
    for r in spark.read.parquet(f"{small}/conversations.parquet").orderBy("conv_id", "turn").collect():
        talks[r.conv_id].append((r.turn, r.text))
    want = []
    for conv, turns in talks.items():
        sides = []
        for (turn, text), after in zip(turns, [*turns[1:], (None, "")], strict=True):
            latin = replaced(text, [("er ", "er λόγος id est "), ("en ", "en ἀρχή "), ("is ", "is τοῦ θεοῦ ")])
            english = replaced(after[1], [("er ", "er λογος "), ("on ", "on αρχη "), ("ta", "t[a")])
            if text.strip():
                sides.append((turn, latin, english))
        for i, (turn, latin, _) in enumerate(sides):
            near, far = (plain(" ".join(e for *_, e in sides[max(0, i - k) : i + k + 1])) for k in (1, 5))
            for m in re.finditer(f"[{GREEK}](?:[{GREEK} ,'’ʼ]*[{GREEK}])?", latin):
                span = plain(m[0])
                if len(re.findall(f"[{GREEK}]", m[0])) < 3:
                    continue
                if span not in near:
                    want.append((f"p{conv:04}_{turn}", "GREEK_DROPPED", m[0]))
                    continue
                letters = sum("LATIN" in unicodedata.name(c, "") for c in latin)
                glossed = "[" in far[far.index(span) + len(span) :]
                if letters >= 4 and not glossed and not re.search(CUES, latin[m.end() : m.end() + 30], re.IGNORECASE):
                    want.append((f"p{conv:04}_{turn}", "BRACKET_GLOSS_MISSING", m[0]))
    got = [(r.segment_id, r.flag, r.span) for r in Q.greek_validator(spark, small).collect()]
    assert sorted(got) == sorted(want)
    assert {f for _, f, _ in want} == {"GREEK_DROPPED", "BRACKET_GLOSS_MISSING"}
