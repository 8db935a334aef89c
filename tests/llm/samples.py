"""Small document tables with the cases every operator has to bear."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Columns that operators use inside; a table may have them, too.
CLASHING = ["id", "key", "span", "runs", "kept", "size", "packed", "class", "host", "shard", "rank", "sequence_id", "score", "_cell", "n_tokens"]


def words(draw: random.Random, number: int) -> list[str]:
    return ["".join(draw.choice("abcdeéß") for _ in range(draw.randint(1, 7))) for _ in range(number)]


def documents(seed: int = 5) -> list[tuple]:
    """Copies, near copies, shared passages, periodic texts, nulls, blanks and a very long text."""
    draw = random.Random(seed)
    passage = words(draw, 90)
    base = words(draw, 200)
    texts: list[str | None] = [None, "", "   \n", "one", "Two words"]
    texts += [" ".join(words(draw, draw.randint(30, 160))) for _ in range(25)]
    texts += [" ".join(base)] * 6
    for _ in range(12):
        near = list(base)
        for _ in range(draw.randint(1, 6)):
            near[draw.randrange(len(near))] = draw.choice(words(draw, 3))
        texts.append(" ".join(near))
    texts += [" ".join(words(draw, 40) + passage[draw.randint(0, 30) :] + words(draw, 20)) for _ in range(8)]
    texts += ["again " * 300, "again " * 120 + "end", "two step " * 200, "three step dance " * 90, "x\ty\n" * 300]
    texts.append(" ".join(words(draw, 30_000)))
    texts.append("NoSpaceAtAll" * 400)
    texts += [" wide　space  \r\n tabs\t\tand <|endoftext|> specials ", "don't 123 ½ 日本 🙂"]
    order = list(range(len(texts)))
    draw.shuffle(order)
    rows = [(number * 3 - 20, texts[at], "en", draw.choice(["a", "b", "B", "é", None]), 0) for number, at in enumerate(order)]
    return rows


def frame(spark, rows: list[tuple], extra: bool = False):
    df = spark.createDataFrame(rows, DOCS).repartition(7)
    for name in CLASHING if extra else ():
        df = df.selectExpr("*", f"'clash' AS `{name}`")
    return df
