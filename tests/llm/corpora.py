"""Small corpora with everything that may come: copies, near copies, odd rows, clashing columns."""

from __future__ import annotations

import random

WORDS = "the of and to in is that for it was on with as his they be at one have this".split() + [f"w{k}x" for k in range(300)]
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, id long, data string, digest string, "
          "bucket int, node long, word string, row long, key string, line string, label int")
CLASH = (1, "x", "x", 2, 3, "x", 4, "x", "x", 7)


def passage(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) for _ in range(n))


def texts(seed: int = 1, n: int = 80) -> list[tuple[int, str]]:
    """Texts with exact copies, copies in capitals, near copies and shared passages."""
    rng, out = random.Random(seed), []
    shared = [passage(rng, 40) for _ in range(3)]
    for k in range(n):
        turn = rng.random()
        if out and turn < 0.15:
            text = rng.choice(out)[1]
            text = text.upper() if turn < 0.05 else text
        elif out and turn < 0.4:
            words = rng.choice(out)[1].split(" ")
            for _ in range(rng.randint(1, 4)):
                words[rng.randrange(len(words))] = rng.choice(WORDS)
            text = " ".join(words)
        else:
            text = passage(rng, rng.randint(1, 120))
            if turn < 0.6:
                text += "\n" + rng.choice(shared) + " " + passage(rng, 5)
        out.append((k * 3 + 1, text))
    return out


def odd_texts() -> list[tuple[int | None, str | None]]:
    """Nulls, blanks, repeated rows, one id with two texts, ties, unusual characters, a long text."""
    long = passage(random.Random(5), 30_000)
    return [(1000, None), (1001, ""), (1002, " \n\t "), (None, None), (None, "the of and to in it"), (1003, "the of"),
            (1004, "the of"), (1004, "the of"), (1005, "THE OF"), (1005, "the of"), (1006, "Ⅷ ſs İ\u0085x \x1c é é <|endoftext|> 日本語 😀"),
            (1007, long), (1008, long + " end"), (1009, "a" * 5000)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None, *CLASH) for i, t in rows], SCHEMA).repartition(3)
