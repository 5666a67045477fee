"""Documents with everything that may go wrong, and brute-force versions in plain Python."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside or return.
CLASHING = ["row", "at", "kept", "size", "copies", "shard", "slot", "ids", "n", "id", "class", "component", "digest",
            "lang_pred", "score", "fingerprint", "next", "deleted", "copy", "bucket"]
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    stems = ["ha", "re", "the", "on", "ti", "ing", "é", "ou", "ß", "st"]
    text = ["".join(rng.choices(stems, k=rng.randint(1, 4))) for _ in range(words)]
    return "".join(word + rng.choice([" ", " ", " ", ", ", ".\n"]) for word in text)


def documents() -> list[tuple]:
    long = prose(1, 9000)
    base = prose(2, 120)
    near = [base + f" tail{k}" for k in range(30)]
    texts = [None, "", " \t\n", "one", "one", "A b", "a  B", "漢字 𐍈 é", "</s>[INST]", long, long, base, *near, prose(3, 40)]
    rows = [(k, text, ["en", "fr", None][k % 3], ["s1", "s2", None, "s10"][k % 4], 0) for k, text in enumerate(texts)]
    return [*rows, rows[9], rows[11], (None, "lost", None, None, None), (None, "lost", None, None, None)]


def frame(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, SCHEMA)


def clashing(df):
    from pyspark.sql import functions as F

    return df.withColumns({name: F.lit("x") for name in CLASHING})


def shingles(text: str | None, n: int = 3) -> frozenset:
    words = WORD.findall((text or "").translate(LOWER))
    size = min(n, len(words))
    return frozenset(tuple(words[k : k + size]) for k in range(len(words) - size + 1)) if words else frozenset()


def components(rows: list[tuple[int, str | None]], words: int = 3, percent: int = 90) -> dict[int, int]:
    sets = {key: shingles(text, words) for key, text in rows}
    parent = {key: key for key in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                one, two = find(a), find(b)
                parent[max(one, two)] = min(one, two)
    return {key: find(key) for key in keys}
