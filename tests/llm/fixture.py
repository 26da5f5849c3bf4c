"""A small table with copies, near copies, repeats, odd texts, ties and nulls."""

import random


def documents(seed=1, n=60):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdefgh", k=rng.randint(1, 5))) for _ in range(300)] + ["é…", "ßtraße", "日本"]
    say = lambda k: rng.choices(vocabulary, k=k)
    passage, shared = say(60), say(25)
    rows = []
    for i in range(n):
        w = say(rng.randint(1, 120))
        if i % 4 == 0:
            at = rng.randint(0, len(w))
            w[at:at] = passage[rng.randint(0, 20): rng.randint(35, 60)]
        if i % 5 == 0:
            w += shared
        if i % 9 == 0 and rows:  # near copy
            w = rows[rng.randrange(len(rows))][1].split()
            if w:
                w[rng.randrange(len(w))] = "changed"
        text = " ".join(w)
        if i % 6 == 0:
            text = text.replace(" ", "\n", 3).replace(" ", "  ", 2).replace(" ", "\t", 1)
        rows.append((i * 3 % (n * 2), text))
    rows += [(1000 + k, t) for k, t in enumerate([
        None, "", " \n\t ", "x", "a a a a a a a a a a a a a a a a a a a a", "a b " * 30, "a b " * 20 + "end",
        "Same text here", "Sametext here", " same text here", "one\ntwo\nthree\none\ntwo\nthree\n", "\n\n\n\n",
        "one\ntwo\nthree\nfour", rows[0][1], rows[0][1] + " ", "z" * 500, "y" + "z" * 450, "x\x0by\x0cz\rw v\x85u",
        " ".join(passage), "<|endoftext|> é " * 8, " ".join(say(30000)), "|".join(say(20)), "A B C D E F G H I J K L M N"])]
    rows += [(5, rows[3][1]), (5, rows[3][1]), rows[4], (None, rows[2][1]), (None, "no id at all"), (None, None)]
    return rows


SCHEMA = "doc_id long, text string"


def frame(spark, rows, extra=True):
    """The rows as a table; ``extra`` adds columns whose names operators use inside."""
    if not extra:
        return spark.createDataFrame(rows, SCHEMA).repartition(3)
    full = [(i, t, "en", f"s{n % 3}", n, None, float(n)) for n, (i, t) in enumerate(rows)]
    schema = SCHEMA + ", lang string, id string, block int, sha string, n_words double"
    return spark.createDataFrame(full, schema).repartition(3)
