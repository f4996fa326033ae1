import random

import pytest


@pytest.fixture(scope="session")
def prose():
    """Invented texts with copies, near copies, shared passages, odd characters and very short ones."""
    rng = random.Random(7)
    syllables = ["an", "er", "th", "in", "on", "eé", "ßu", "ing", "re", "st"]

    def word():
        return "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))

    def text(n):
        return " ".join(word() + rng.choice(["", "", ",", ".", "\n"]) for _ in range(n))

    shared = text(30)
    out = ["", "x", "  ", "Ab", "\x00 odd \x7f"]
    for n in (5, 40, 200):
        out += [text(n) for _ in range(6)]
    out += [f"{text(20)} {shared} {text(20)}" for _ in range(6)]
    out += [out[12], out[12], out[14][:-3] + "zz", out[14].upper(), "a" * 400, "a" * 500, text(4000)]
    near = out[18].split(" ")
    for i in range(8):
        copy = list(near)
        copy[i * 7 % len(copy)] = f"edit{i}"
        out.append(" ".join(copy))
    rng.shuffle(out)
    return out
