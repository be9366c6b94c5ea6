"""Documents with the awkward cases: nulls, empty and long texts, ties, repeated rows."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
EXTRA = SCHEMA + ", n_tokens string, ids string, kept string, key string, lead string"


def words(rnd: random.Random, n: int, vocabulary: int = 400) -> str:
    syllables = ["an", "the", "on", "er", "ti", "re", "ou", "es", "ha", "ble", "tz", "é"]
    return " ".join("".join(syllables[(w * 7 + k * w // 5) % 12] for k in range(1 + w % 4)) for w in (rnd.randrange(vocabulary) for _ in range(n)))


def corpus(seed: int = 5) -> list[tuple]:
    rnd = random.Random(seed)
    rows, texts = [], []
    passage = words(rnd, 60)
    for i in range(60):
        texts.append("\n".join(words(rnd, rnd.randrange(5, 40)) for _ in range(rnd.randrange(1, 6))))
    for i in range(12):  # near copies, exact copies, shared passages
        near = texts[i].split(" ")
        near[len(near) // 2] = "zzedit"
        texts += [" ".join(near), texts[i], words(rnd, 20) + " " + passage + " " + words(rnd, 15)]
    texts += [texts[0] + "\n" + texts[0], "x", "", None, "   \n\t ", "one two", "<|endoftext|> a", "a" * 3000, "é😀" * 400, words(rnd, 6000), "▁ a  b "]
    for i, t in enumerate(texts):
        rows.append((i * 3 + 1, t, rnd.choice(["en", "de", None, "xx"]), None if i % 7 == 0 else f"s{i % 3}", None if t is None else len(t)))
    rows.append((None, texts[1], None, None, None))  # a row without an id
    rows.append(rows[4])  # a repeated row
    rnd.shuffle(rows)
    return rows


def frame(spark, rows=None):
    return spark.createDataFrame(corpus() if rows is None else rows, SCHEMA)


def clashing(spark, rows=None):
    """The same with columns whose names operators use themselves."""
    rows = corpus() if rows is None else rows
    return spark.createDataFrame([(*r, "a", "b", "c", "d", "e") for r in rows], EXTRA)
