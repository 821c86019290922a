"""Small tables for the tests of the subpackage."""

import random

WORDS = "the of and to in is was for on with as by at from are this that".split()


def prose(rng: random.Random, n: int) -> str:
    syllables = ["ta", "ri", "mo", "ne", "lu", "ka", "so", "pe"]
    out = []
    for _ in range(n):
        if rng.random() < 0.4:
            out.append(rng.choice(WORDS))
        else:
            out.append("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))))
    return " ".join(out)


def rows(df, *columns):
    """Rows as tuples, in an order that nulls do not break."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars int"
