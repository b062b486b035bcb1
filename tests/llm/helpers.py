"""Small tables with the awkward rows every operator must take."""

from __future__ import annotations

import random
import re

UPPER = {c: c + 32 for c in range(65, 91)}
ODD_TEXTS = [None, "", " \t\n", "one", "Two words", "é ß ﬁn", "x" * 50_000, "a\x1cb c", "<|im_end|>", "tail\n\n\n"]


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" + ("." if rng.random() < 0.1 else "") for _ in range(n))


def edited(text: str, seed: int, share: float) -> str:
    rng = random.Random(seed)
    return " ".join(w + "q" if rng.random() < share else w for w in text.split(" "))


def documents(spark, texts):
    """doc_id from 0, with columns of clashing names that no operator may trip over."""
    rows = [(i, t, "odd" if t in ODD_TEXTS else "en", "s", len(t or ""), 1, "z", 2.0) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n long, node string, score double")
