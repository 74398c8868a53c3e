"""Rules that tests restate in plain Python."""

import re

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(int(c) if i % 2 == 0 else (2 * int(c) - 9 if int(c) > 4 else 2 * int(c)) for i, c in enumerate(reversed(d))) % 10 == 0


def base_spans(text):
    """(start, end, kind) of the four base kinds."""
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                  "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append((m.start(), m.end(), kind))
    return out


def spans_redacted(text):
    """The text with every span replaced by its kind; overlapping ones become one."""
    out, at = "", 0
    for start, end, kind in sorted(base_spans(text)):
        if start >= at:
            out += text[at:start] + f"<{kind.upper()}>"
        at = max(at, end)
    return out + text[at:]
