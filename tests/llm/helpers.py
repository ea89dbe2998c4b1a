"""Rows that every operator must take, and texts made by rule."""

import random

from pyspark.sql import DataFrame, SparkSession

#: Columns that clash with names the operators use inside.
EXTRA = ("thash", "marks", "kind", "chunk", "owner", "payload", "n", "cls", "size", "key", "score", "suspect", "kept", "block", "gone_id", "tie")


def words(rng: random.Random, n: int, vocabulary: int = 400) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def frame(spark: SparkSession, rows, schema: str = "doc_id long, text string, lang string, source string", extra: bool = True) -> DataFrame:
    df = spark.createDataFrame(rows, schema)
    if extra:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit("clash") for c in EXTRA})
    return df.repartition(3)


def corpus(seed: int = 5) -> list[tuple]:
    """Copies, near copies, shared passages, a hot line, blanks, nulls, a long text and repeated rows."""
    rng = random.Random(seed)
    hot = "the one line that very many documents have in common today and tomorrow"
    texts: list[str | None] = []
    for i in range(24):
        lines = [" ".join(words(rng, rng.randrange(5, 40))) for _ in range(rng.randrange(1, 5))]
        texts.append("\n".join([hot, *lines] if i % 2 else lines))
    texts += [texts[0], texts[0].replace(" ", "  \t"), " " + texts[1], texts[1] + "\n"]
    passage = " ".join(words(rng, 60))
    texts += [passage + " " + " ".join(words(rng, 10)), " ".join(words(rng, 7)) + " " + passage, passage + "\n" + passage]
    base = words(rng, 120)
    for _ in range(6):
        copy = list(base)
        copy[rng.randrange(120)] = "changed"
        texts.append(" ".join(copy))
    texts += [" ".join(words(rng, 6000, 3000)), "", " \n\t ", None, "one", "One", "one two three", "déjà vu ÀÉ 数学 𝒳 x"]
    rows = [(i, t, "en", f"src{i % 3}") for i, t in enumerate(texts)]
    return [*rows, (3, texts[3], "en", "src0"), (None, texts[5], None, None), (None, "alone without an id", None, "src1")]
