"""Texts with copies, shared passages, repeated lines and every odd case."""

import random

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omikron pi rho sigma tau upsilon phi chi psi omega été über niño".split()


def prose(rnd: random.Random, n: int) -> str:
    out = []
    for i in range(n):
        out.append(rnd.choice(WORDS) + rnd.choice(WORDS)[:3] + rnd.choice(["", "", "", ",", "."]))
        out.append("\n" if rnd.random() < 0.05 else " ")
    return "".join(out).strip()


def altered(rnd: random.Random, text: str, share: float) -> str:
    return " ".join(rnd.choice(WORDS) + "x" if rnd.random() < share else w for w in text.split(" "))


def texts(seed: int, n: int = 60) -> list[str | None]:
    """Prose with exact and near copies, shared passages, repeated lines, and every odd case."""
    rnd = random.Random(seed)
    own = [prose(rnd, rnd.choice([3, 15, 60, 200])) for _ in range(n)]
    passage, line = prose(rnd, 60), "This line stands in very many of the documents, with few changes."
    own += [prose(rnd, 20) + " " + passage + " " + prose(rnd, 10) for _ in range(6)]
    own += [altered(rnd, own[3], 0.03) for _ in range(5)] + [own[4]] * 4
    own += [prose(rnd, 10) + "\n" + line.replace("few", w) + "\n" + prose(rnd, 10) for w in ("few", "fev", "no", "few")]
    return [*own, None, "", " \n\t", "word", "a b", "<|endoftext|>", "0" * 450, "é" * 300, own[4], "x" + passage]


COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, key string, h long, text_ string"


def pairs_of(frame) -> list[tuple]:
    return [(r.doc_id, r.text or "") for r in frame.collect()]
