import random

import pytest

WORDS = "the and of to in ere thon eshe ing wand lor mip dolt 'x, b. Été".split()


def prose(rng, count):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(count))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Copies, near copies, shared passages, short, empty, null, long and repeated rows, and columns with awkward names."""
    rng = random.Random(5)
    texts = [prose(rng, rng.randrange(30, 200)) for _ in range(40)]
    texts += [texts[i] for i in (0, 1, 1, 1)] + [texts[2].upper(), texts[3].replace(" ", "\n")]
    for base in (4, 4, 4, 5, 6):
        words = texts[base].split()
        words[rng.randrange(len(words))] = "changed"
        texts.append(" ".join(words))
    passage = prose(rng, 60)
    texts += [prose(rng, 20) + " " + passage + " " + prose(rng, 30) for _ in range(3)]
    texts += ["", " \n ", "one", "one two three", "one two three", "a " * 50, prose(rng, 5000), "x" * 5000, " nbsp is no space"]
    rows = [(i, t, ["en", "de", None][i % 3], f"s{i % 2}", len(t), i, f"b{i}") for i, t in enumerate(texts)]
    rows += [(500, None, None, None, None, None, None), (None, texts[0], "en", "s0", 3, 1, "x"), rows[7], rows[7]]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, id int, block string"
    ).selectExpr("*", "block as `row`", "id as `key`", "id as `kept_id`")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
