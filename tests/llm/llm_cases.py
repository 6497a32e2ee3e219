"""Small frames with the cases every operator must survive."""

import random

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, n_words string, tag string, row string, "
        "length string, block string, anchor string, words string, rest string, component string")
EXTRA = ("clash",) * 9


def awkward(spark, texts):
    """``texts`` as documents 1.., with clashing extra columns, plus null and repeated rows and keys."""
    rows = [(i + 1, t) for i, t in enumerate(texts)]
    rows += [(901, None), (902, ""), (903, " \t\n\r\x0b\x0c"), (904, "word"), rows[0], rows[0], (None, texts[0]), (None, None), (905, "x" * 5000)]
    return spark.createDataFrame([(i, t, "en", None if i and i % 7 == 0 else f"src{(i or 0) % 3}", len(t or ""), *EXTRA) for i, t in rows], DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def prose(seed, n, size=400, vocabulary=60):
    """Random texts that share passages, lines and near copies."""
    r = random.Random(seed)
    word = [f"w{i}" + r.choice(["", "a", "é", ",", "."]) for i in range(vocabulary)]
    out = []
    for _ in range(n):
        text = [r.choice(word) for _ in range(r.randrange(1, size))]
        for _ in range(r.randrange(3)):
            if out:
                other = r.choice(out).split()
                a = r.randrange(len(other))
                at = r.randrange(len(text))
                text[at:at] = other[a:a + r.randrange(5, 80)]
        out.append("".join(x + r.choice([" ", " ", " ", "\n", "  "]) for x in text))
        if r.random() < 0.25:
            copy = out[-1].split(" ")
            for _ in range(r.randrange(4)):
                copy[r.randrange(len(copy))] = r.choice(word)
            out.append(" ".join(copy))
    return out


def key(row):
    return tuple((x is None, str(x)) for x in row)
