"""Plain versions of what the pipeline's stages do, a document after another, for small tables."""

import datetime
import hashlib
import re

import regex

from gridloom.llm import pii


def labelled(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    seen, out = {}, []
    for i in range(max(1, len(words) - 4) if words else 0):
        s = tuple(words[i : i + 5])
        seen[s] = seen.get(s, -1) + 1
        out.append((s, seen[s]))
    return out


def common_in_order(a, b):
    """The longest common subsequence by the whole table."""
    row = [0] * (len(b) + 1)
    for x in a:
        before, row = row, [0]
        for j, y in enumerate(b):
            row.append(before[j] + 1 if x == y else max(row[-1], before[j + 1]))
    return row[-1]


def classes(docs):
    """{id: smallest id of its class} of {id: text}: equal texts, and pairs of in-order similarity 0.8, transitively."""
    parent = {i: i for i in docs}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    lists = {i: labelled(t) if t is not None else [] for i, t in docs.items()}
    sets = {i: set(x) for i, x in lists.items()}
    ids = sorted(docs)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            if docs[i] is None or docs[j] is None:
                continue
            linked = docs[i] == docs[j]
            if not linked and sets[i] and 9 * len(sets[i] & sets[j]) >= 4 * (len(sets[i]) + len(sets[j])):
                common = common_in_order(lists[i], lists[j])
                linked = common / (len(lists[i]) + len(lists[j]) - common) >= 0.8
            if linked:
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return {i: root(i) for i in ids}


KEY = "a key of the tests"


def feistel(left, right, left_size, right_size, tweak, key=KEY):
    for i in range(1, 9):
        hashed = lambda half: int(hashlib.sha256(f"{key}|{tweak}|{i}|{half}".encode()).hexdigest()[:15], 16)  # noqa: B023, E731
        if i % 2:
            left = (left + hashed(right) % left_size) % left_size
        else:
            right = (right + hashed(left) % right_size) % right_size
    return left, right


def permuted(d, tweak):
    half, rest = len(d) // 2, len(d) - len(d) // 2
    left, right = feistel(int(d[:half]), int(d[half:]), 10**half, 10**rest, tweak)
    return f"{left:0{half}d}{right:0{rest}d}"


def moved(text, other, side, i):
    draws = "".join(hashlib.sha512(f"{KEY}|email|{side}|{i}|{b}|{other}".encode()).hexdigest() for b in range(len(text) // 32 + 1))
    out = ""
    for k, c in enumerate(text):
        draw = int(draws[4 * k : 4 * k + 4], 16)
        low, size = ("0", 10) if c in "0123456789" else ("a", 26) if "a" <= c <= "z" else ("A", 26) if "A" <= c <= "Z" else (c, 1)
        out += chr((ord(c) - ord(low) + draw) % size + ord(low))
    return out


def iban_rest(text):
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


def as_date(m):
    """(date, order of the parts) or None."""
    parts = list(map(int, re.split(r"[./\-]", m)))
    orders = ("ymd",) if re.match(r"\d{4}", m) else ("dmy",) if "." in m else ("dmy", "mdy")
    for order in orders:
        y, mo, d = (parts[order.index(x)] for x in "ymd")
        try:
            found = datetime.date(y, mo, d)
        except ValueError:
            continue
        return (found, order) if 1900 <= y <= 2099 else None
    return None


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (2 if i % 2 == 0 else 1)
        total += v - 9 * (v > 9)
    return d + str(-total % 10)


def refilled(text, digits):
    digits = iter(digits)
    return re.sub("[0-9]", lambda _: next(digits), text)


def pseudonym(kind, m):
    """The pseudonym of a match, None if its check digits or the calendar say that it is none."""
    d = re.sub("[^0-9]", "", m)
    if kind == "email":
        rest, top = m[: m.rindex(".") + 1], m[m.rindex(".") + 1 :]
        left, right = rest[: len(rest) // 2], rest[len(rest) // 2 :]
        for i in range(1, 9):
            if i % 2:
                left = moved(left, right.lower(), "l", i)
            else:
                right = moved(right, left.lower(), "r", i)
        return left + right + top
    if kind == "phone" and m.startswith("+") and not m.startswith("+1"):
        return refilled(m, d[:3] + permuted(d[3:], "phone" + d[:3]))
    if kind == "phone":
        ten = d[-10:]
        p = permuted(ten[1:3] + ten[4:], "phone")
        return refilled(m, d[:-10] + ten[0] + p[:2] + ten[3] + p[2:])
    if kind == "card":
        return refilled(m, luhn(d[0] + permuted(d[1:-1], d[0]))) if luhn(d[:-1]) == d else None
    if kind == "ip":
        a, b, c, e = map(int, m.split("."))
        left, right = feistel(a * 256 + b, c * 256 + e, 65536, 65536, "ip")
        return ".".join(map(str, (left // 256, left % 256, right // 256, right % 256)))
    if kind == "ssn":
        a, g, n = map(int, m.split("-"))
        place, serial = feistel((a - (2 if a > 666 else 1)) * 99 + g - 1, n - 1, 898 * 99, 9999, "ssn")
        area = place // 99 + 1
        return f"{area + (area >= 666):03d}-{place % 99 + 1:02d}-{serial + 1:04d}"
    if kind == "iban":
        plain = m.replace(" ", "")
        if iban_rest(plain) != 1:
            return None
        digits = re.sub("[^0-9]", "", plain[4:])
        account = refilled(plain[4:], permuted(digits, plain[:2])) if len(digits) > 1 else plain[4:]
        check = 98 - iban_rest(plain[:2] + "00" + account)
        return refilled(m, f"{check:02d}" + re.sub("[^0-9]", "", account))
    found = as_date(m)
    if found is None:
        return None
    n = (found[0] - datetime.date(1900, 1, 1)).days
    left, right = feistel(n // 4297, n % 4297, 17, 4297, "date")
    other = datetime.date(1900, 1, 1) + datetime.timedelta(left * 4297 + right)
    bare = re.search(r"(?<!\d)\d(?!\d)", m)
    shown = {"y": str(other.year), "m": str(other.month) if bare else f"{other.month:02d}", "d": str(other.day) if bare else f"{other.day:02d}"}
    return re.search(r"[./\-]", m)[0].join(shown[x] for x in found[1])


def pseudonymised(text):
    def one(m, kinds=tuple(pii.PATTERNS)):
        kind = next(k for k in kinds if regex.fullmatch(pii.PATTERNS[k], m[0]))
        other = pseudonym(kind, m[0])
        if other is None and re.match(r"[A-Z]{2}\d\d", m[0]):
            rest = tuple(k for k in kinds if k != "iban")
            return regex.sub(pii.INSIDE, lambda x: one(x, rest), m[0])
        return m[0] if other is None else other

    return regex.sub(pii.ANY, one, text)


def mixed(rows):
    """{id: (size, source_size, target, taken)} of (id, text, source): resharing round by round, sorting by hash."""
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _ in rows}
    sources = sorted({s for _, _, s in rows}, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sources)}
    total = {s: sum(size[i] for i, _, x in rows if x == s) for s in sources}
    target, capped = {}, set()
    while True:
        rest = sum(total.values()) - sum(3 * total[s] for s in capped)
        weights = sum(weight[s] for s in sources if s not in capped)
        target = {s: 3.0 * total[s] if s in capped else rest * weight[s] / weights for s in sources}
        over = {s for s in sources if s not in capped and target[s] > 3 * total[s]}
        if not over:
            break
        capped |= over
    out = {}
    for s in sources:
        own = sorted((i for i, _, x in rows if x == s), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
        base = int(target[s] // total[s]) if total[s] else 0
        rest = target[s] - base * total[s]
        held, more = 0, set()
        for i in own:
            if held + size[i] <= rest or (held <= rest and held + size[i] - rest < rest - held):
                more.add(i)
                held += size[i]
            else:
                break
        for i in own:
            out[i] = (size[i], total[s], target[s], size[i] * min(3, base + (i in more and rest > 0)))
    return out
