"""Small tables with the awkward rows every operator must take, and brute-force results."""

from __future__ import annotations

import random
import re

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
AWKWARD_TEXTS = [
    None, "", " \t\r\n\x0b", "word", "\n\n\n", "one two\nONE TWO\n\none  two.", "ñandú Ünïcode — 漢字 текст", "x" * 5000, "a " * 3000,
    "  line separators\u0085 are letters here", "tab\tand\rreturn", "quote \" back\\slash \x00 nul",
]


def docs_of(spark, texts, extra: bool = False):
    rows = [(i, t, "en" if i % 3 else None, None if i % 5 == 4 else f"src{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOC_SCHEMA)
    if extra:  # names that the operators use themselves
        for name in ("row", "size", "target", "score", "rejected", "gone", "id", "text_id", "kept", "h1", "n", "hash", "label", "bits"):
            df = df.selectExpr("*", f"'mine' AS `{name}`")
    return df


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    out = []
    for k in range(words):
        out.append("".join(rng.choice("aeioulnrst") for _ in range(2 + rng.randrange(vocabulary) % 7)))
        if k % 12 == 11:
            out[-1] += ".\n" if k % 36 == 35 else "."
    return " ".join(out).replace("\n ", "\n")


def corpus(seed: int = 1, n: int = 60) -> list:
    """Awkward texts, prose, exact and near copies, shared lines."""
    rng = random.Random(seed)
    texts = list(AWKWARD_TEXTS)
    for k in range(n):
        kind = rng.random()
        if k and kind < 0.15:
            texts.append(rng.choice(texts))
        elif k and kind < 0.4:
            words = re.split(r"( |\n)", rng.choice([t for t in texts if t and len(t) > 200]))
            for _ in range(rng.randrange(1, 6)):
                words[rng.randrange(len(words))] = rng.choice(["", "edited", "swap"])
            texts.append("".join(words))
        else:
            texts.append(prose(seed * 1000 + k, rng.choice([3, 20, 60, 200])) + rng.choice(["", "\nThe same closing line that many of the documents share in full."]))
    return texts


def components(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def ascii_lower(text: str) -> str:
    return text.translate({c: c + 32 for c in range(65, 91)})


def rows(df):
    return [r.asDict() for r in df.collect()]
