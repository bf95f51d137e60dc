"""Quadratic line dedup, for comparison."""


def brute(docs: list[tuple[int, str]], min_words: int) -> dict[int, str]:
    texts = [(d, t.split("\n")) for d, t in sorted(docs)]
    places = {}
    for a, (_, lines) in enumerate(texts):
        for i, line in enumerate(lines):
            places.setdefault(line, []).append((a, i))
    out = {}
    for a, (d, lines) in enumerate(texts):
        gone = set()
        for i, line in enumerate(lines):
            best = 0
            for b, j in places[line]:
                if (b, j) >= (a, i):
                    break
                n = 0
                other = texts[b][1]
                while i + n < len(lines) and j + n < len(other) and lines[i + n] == other[j + n]:
                    n += 1
                best = max(best, n)
            if sum(len(x.split()) for x in lines[i : i + best]) >= min_words:
                gone.update(range(i, i + best))
        out[d] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
    return out
