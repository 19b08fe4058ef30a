import random


def words(rng: random.Random, n: int, stock: int = 4000) -> str:
    return " ".join(f"w{rng.randrange(stock)}x" for _ in range(n))
