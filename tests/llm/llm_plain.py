"""Plain helpers of the brute-force versions."""

import re


def lower_ascii(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


def space_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def text_of(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))
