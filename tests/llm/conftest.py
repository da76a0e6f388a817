import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, shard int, root double, start string"


def odd_texts():
    """Texts with all that is unusual: nulls, empties, copies, near copies, shared passages, very long ones."""
    rng = random.Random(11)
    vocabulary = ["".join(rng.choices("abcdefghié", k=rng.randint(1, 9))) for _ in range(400)]

    def prose(n):
        return " ".join(rng.choices(vocabulary, k=n))

    passage, copied = prose(45), prose(120)
    texts = [None, "", "   \n\t ", "one", "Two words", "three little words", "<|endoftext|> as text", "😀 naïve\x0bcafé x　y"]
    texts += [prose(rng.randint(1, 300)) for _ in range(40)]
    texts += [f"{prose(20)} {passage} {prose(30)}" for _ in range(6)]
    texts += [f"{passage} {passage}"]
    texts += [copied] * 12 + [copied + " more", copied.upper()]
    texts += [prose(30_000), "x" * 1_300_000 + " " + prose(50), " ".join(["again"] * 5_000)]
    texts += ["a b a b a b a b a b a b a b a b a b a b a b a b a b a b"]
    return texts


@pytest.fixture(scope="session")
def odd_rows():
    """Rows with null and repeated ids and repeated rows, in no order of ids."""
    texts = odd_texts()
    ids = [*range(100, 100 + len(texts))]
    random.Random(3).shuffle(ids)
    rows = list(zip(ids, texts))
    rows += [rows[9], rows[9], (rows[20][0], "another text under an id that is taken"), (None, "no id"), (None, "no id either"), (None, None)]
    langs = [None, "en", "fr"]
    return [(i, t, langs[n % 3], None, None, "r", n, 1.5, "s") for n, (i, t) in enumerate(rows)]


@pytest.fixture(scope="session")
def odd_documents(spark, odd_rows, tmp_path_factory):
    """The odd rows as a table of several files, with columns whose names the operators use themselves."""
    path = str(tmp_path_factory.mktemp("odd") / "documents.parquet")
    spark.createDataFrame(odd_rows, SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def no_documents(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("none") / "documents.parquet")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    return spark.read.schema(SCHEMA).parquet(path)
