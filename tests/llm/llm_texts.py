import random

WORDS = "the of and river stone light under house carry paper number fast slow green window door".split()


def prose(n, seed):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + (str(rng.randrange(50)) if rng.random() < 0.5 else "") for _ in range(n))
