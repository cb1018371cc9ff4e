import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns under names that the operators use inside.
CLASH = ("tag string, seed long, at long, repeats string, mix_tokens string, row string, word string, "
         "fp string, language string, n long")


def messy_rows():
    """Nulls in any column, empty and long texts, ties, repeated rows, shared passages."""
    rng = random.Random(4)
    word = {"en": "the of thing and ouble stion ent", "fr": "le de oiment la queeau ierre",
            "de": "der und schkeit ung einber die"}
    vocab = {k: [a + b for a in v.split() for b in ("", *v.split())] for k, v in word.items()}
    passage = " ".join(rng.choice(vocab["en"]) for _ in range(60))
    rows = []
    for i in range(60):
        lang = ("en", "fr", "de")[i % 3]
        text = " ".join(rng.choice(vocab[lang]) for _ in range(rng.randrange(1, 160)))
        if i % 4 == 0:
            text = text[:40] + " " + passage + "\n" + text[40:]
        rows.append((i, text, lang, f"s{i % 4}", len(text)))
    rows += [(100, rows[5][1], "fr", "s1", None), (101, rows[5][1] + " fin", None, None, 3)]
    rows += [rows[8], rows[8], (8, "another text under an id in use", "en", "s0", 1)]
    rows += [(None, rows[12][1], "en", "s0", 1), (None, None, None, None, None)]
    rows += [(200, None, "en", "s2", None), (201, "", "en", "s2", 0), (202, " \t\n\x0b\x0c\r ", None, "s3", 7),
             (203, "### 123 %%%\n### 123 %%%\n\n", "de", "s3", 5), (204, "漢字 é ß x²3 \U0001f600 don't", "fr", "s1", 9),
             (205, "a a a a " * 3000, "en", "s0", 24000), (206, passage, "en", "s9", 1)]
    return rows


@pytest.fixture(scope="session")
def messy():
    return messy_rows()


@pytest.fixture(scope="session")
def messy_docs(spark, messy):
    clash = ("t", 1, 2, "r", "m", "row", "w", "f", "l", 3)
    return spark.createDataFrame([r + clash for r in messy], f"{DOCS}, {CLASH}").repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
