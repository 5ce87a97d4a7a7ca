"""Small documents with nulls, empty and long texts, ties, repeated rows, copies and clashing columns."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def word(rng: random.Random) -> str:
    return "".join(rng.choice("abcdeéilmnorstuß") for _ in range(rng.randint(2, 7)))


def text(rng: random.Random, n: int) -> str:
    out = [word(rng) for _ in range(n)]
    return "".join(w + ("\n" if rng.random() < 0.08 else " ") for w in out).strip()


def changed(rng: random.Random, base: str, n: int) -> str:
    words = base.split(" ")
    for i in rng.sample(range(len(words)), n):
        words[i] = word(rng)
    return " ".join(words)


def rows(seed: int = 1) -> list[tuple]:
    rng = random.Random(seed)
    texts: list[str | None] = [text(rng, rng.choice([1, 3, 4, 5, 6, 12, 30, 80, 150])) for _ in range(60)]
    for size, edits in ((12, 1), (40, 1), (90, 2), (140, 3), (140, 5), (200, 8)):
        base = text(rng, size)
        texts += [base, base, *(changed(rng, base, edits) for _ in range(6))]
    line = "the same line that many documents of one host hold, word for word"
    texts += [f"{line}\n{text(rng, 25)}\n{line}" for _ in range(5)] + [f"{line}\n{line}\nshort", line, line.upper(), line[:-1], line + "s", "  " + line]
    repeated = text(rng, 30)
    texts += [repeated + " " + repeated, "a b c d e f g h " * 40, text(rng, 9000), "x" * 3000, "x" * 2999 + "y", "x" * 3001]
    texts += [None, "", " \n\t ", "\n\n", "###$$$ %%%", "123 456", "a", "A", "Ünïcode ñandú <|endoftext|> it's\ttab\x0bodd\x1cspace"]
    out = []
    for i, t in enumerate(texts):
        source = None if i % 17 == 3 else f"s{min(i % 7, i % 3)}"
        lang = None if i % 5 == 0 else ("aa", "bb")[i % 2]
        out.append((i * 3 + 1, t, lang, source, None if t is None else len(t)))
    out.append(out[40])
    out.append(out[62])
    out.append((None, "a text without an id, long enough to count as a document of its own here and there", "aa", "s0", 3))
    out.append((None, None, None, None, None))
    return out
