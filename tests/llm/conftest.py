import pytest

from fieldbook.llm.shared import ship


@pytest.fixture(scope="session")
def texts():
    """Texts with nulls, empty and long ones, copies, near copies and shared passages."""
    import random

    rng = random.Random(5)
    words = [a + b for a in "ba co du fe gi lo mu ny pa re".split() for b in "lan mer tok sil von kar dex ru".split()]

    def prose(n, seed):
        r = random.Random(seed)
        return " ".join(r.choice(words) + ("." if r.random() < 0.1 else "") + ("\n" if r.random() < 0.05 else "") for _ in range(n))

    passage = prose(70, 99)
    docs = [prose(rng.randint(20, 160), k) for k in range(40)]
    docs += [docs[3], docs[3], docs[4] + " more"]
    edited = docs[5].split(" ")
    edited[len(edited) // 2] = "changed"
    docs += [" ".join(edited), prose(30, 7) + " " + passage + " " + prose(30, 8), prose(20, 9) + " " + passage, passage + "é " + prose(40, 10)]
    docs += ["", None, "a", " \n\t ", "ä" * 500, "x" * 700, "and And and " * 90, "né à ß 漢字 🙂 x's  two   spaces\n\n end ", prose(6000, 11), "HE!! RE!! %%% &&& ### " * 20]
    return list(enumerate(docs)) + [(0, docs[0]), (None, docs[6]), (None, None)]


@pytest.fixture(scope="session")
def docs(spark, texts):
    ship(spark)
    rows = [(i, t, "en", "s", None if t is None else len(t), 1, b"x") for i, t in texts]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, row int, ids binary").repartition(3)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.where("false")
