"""Textbook versions of what the operators do, for small inputs."""


def key(name: str) -> str:
    return " ".join(sorted(name.casefold().split()))


def lcs(a: str, b: str) -> int:
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def matches(a: str, b: str, threshold: int = 85) -> bool:
    return 200 * lcs(a, b) >= threshold * (len(a) + len(b))


def score(a: str, b: str) -> float:
    a, b = key(a), key(b)
    return 200.0 * lcs(a, b) / (len(a) + len(b)) if a and b else 0.0


def groups(names: list[str], threshold: int = 85) -> list[tuple[str, list[str]]]:
    """Groups of distinct names visited in the given order."""
    claimed: set[str] = set()
    found = []
    for name in names:
        if name in claimed:
            continue
        near = [other for other in names if other != name and score(name, other) >= threshold]
        if near:
            found.append((name, near))
        claimed.update([name, *near])
    return found


def pairs(rows: list[tuple[str, str]], threshold: int = 85) -> dict[tuple[str, str], float]:
    best: dict[tuple[str, str], float] = {}
    rows = sorted((c, n) for c, n in rows if c is not None and n is not None and key(n))
    for i, (later, x) in enumerate(rows):
        for earlier, y in rows[:i]:
            s = score(x, y)
            if s >= threshold:
                best[later, earlier] = max(s, best.get((later, earlier), 0.0))
    return best


def scorecard(detected: dict[str, list], truth: dict[str, list]) -> dict[str, dict]:
    result = {}
    for category, keys in detected.items():
        found, wanted = set(keys) - {None}, set(truth.get(category, [])) - {None}
        result[category] = (len(wanted), len(found), len(found & wanted))
    result["_overall"] = tuple(map(sum, zip(*result.values()))) if result else (0, 0, 0)
    return result
