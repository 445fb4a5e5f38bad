"""Plain Python versions of the queries' contracts, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib

EMPTY = hashlib.sha256(b"").hexdigest()


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def pii_base(text: str | None) -> dict[str, list[tuple[int, int]]]:
    t = text or ""
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in ("email", "ip", "card", "phone")}
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out["email"].append(m.span())
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out["ip"].append(m.span())
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub(r"[^0-9]", "", m[0])
        if 13 <= len(d) <= 19 and luhn(d):
            out["card"].append(m.span())
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 9 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15:
            out["phone"].append(m.span())
    return out


def secrets_base(text: str | None) -> dict[str, list[tuple[int, int]]]:
    t = text or ""
    assign = re.finditer(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
                         r"([A-Za-z0-9+/_.=-]+)", t)
    return {"assign": [m.span() for m in assign if len(m[2]) >= 8],
            "access": [m.span() for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 16],
            "hex": [m.span() for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 32]}


def digest(rows: list[str]) -> str:
    return hashlib.sha256(",".join(rows).encode()).hexdigest()


def quality_base(text: str | None) -> tuple:
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    seen: set[str] = set()
    dup = 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    where: dict[tuple, list[int]] = {}
    for i in range(len(w) - 2):
        where.setdefault(tuple(w[i:i + 3]), []).append(i)
    covered = {j for at in where.values() if len(at) > 1 for i in at for j in (i, i + 1, i + 2)}
    n = len(w)
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def shingles(text: str | None) -> frozenset:
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def near_duplicates(docs: list[tuple]) -> list[tuple]:
    """(doc_id, n_shingles, component_id) of (doc_id, text) rows, all pairs compared."""
    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * (n := len(a & b)) >= 80 * (len(a) + len(b) - n):
                root[find(i)] = find(j)
    least: dict[int, int] = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(docs)]


def url_parts(url: str | None) -> tuple[str, str]:
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def url_verdict(url: str | None, rules, default: str = "allow") -> tuple:
    host, path = url_parts(url)
    fit = [(len(h + p), len(h), h + p, a) for h, p, a in rules
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=(0, 0, None, default))
    return host, path, best[2], best[3]


def crc(ids: list[int]) -> int:
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
