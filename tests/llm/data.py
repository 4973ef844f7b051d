"""Small made-up corpora with copies, near copies, shared passages and hot groups."""

import random


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(n))


def corpus(seed=0, n=60):
    rng = random.Random(seed)
    docs = {i: "\n".join(prose(rng, rng.randint(3, 40)) for _ in range(rng.randint(1, 6))) for i in range(n)}
    passage = prose(rng, 70)
    for i in range(n, n + 12):  # near copies of near copies
        w = docs[rng.randrange(i)].split(" ")
        w[rng.randrange(len(w))] = "zz"
        docs[i] = " ".join(w)
    for i in range(n + 12, n + 30):  # one hot group of copies
        docs[i] = docs[3]
    for i in range(n + 30, n + 45):  # one hot passage
        docs[i] = prose(rng, rng.randint(1, 30)) + " " + passage + " " + prose(rng, rng.randint(1, 30))
    docs[n + 45], docs[n + 46], docs[n + 47] = "", " \n\t ", "One two THREE"
    docs[n + 48] = "one two three"
    docs[n + 49] = "ab " * 400
    docs[n + 50] = "naïve café 日本語 " * 30
    return docs


def table(spark, docs):
    return spark.createDataFrame([(k, v, "en", "s", len(v or "")) for k, v in docs.items()], "doc_id long, text string, lang string, source string, n_chars long")
