"""Small tables with the awkward rows every operator must handle."""

from __future__ import annotations

import random

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rid long, keep string, words string"


def awkward_texts() -> list[str | None]:
    rnd = random.Random(7)
    word = lambda: "".join(rnd.choice(["th", "er", "on", "an", "re", "é", "ß", "X"]) for _ in range(rnd.randint(1, 4)))
    long = " ".join(word() for _ in range(9000))
    para = " ".join(word() for _ in range(80))
    texts: list[str | None] = [None, "", " ", "\t\n ", "a", "one two three four", "a " * 40, "don't 'tis we've <|endoftext|> 12 ½ 漢字",
                               "x" * 6000, long, long, long + " tail", para, para, para.replace(" ", "\n", 3), para + " end",
                               "head " + para, para.upper(), " nbsp wide", "á combining", "\x00nul\x1f"]
    for _ in range(60):
        base = [word() for _ in range(rnd.randint(1, 120))]
        texts.append(" ".join(base))
        if rnd.random() < 0.5:
            base[rnd.randrange(len(base))] = "edited"
            texts.append(" ".join(base))
    return texts


def awkward_docs(spark, partitions: int = 5):
    """Extra columns clash with names that the operators use inside."""
    rows = [(3 * i + 1, t, None if i % 7 == 0 else "en", None, None, 5, "x", "y") for i, t in enumerate(awkward_texts())]
    return spark.createDataFrame(rows, DOC_SCHEMA).repartition(partitions)


def empty_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
