"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import re

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")


def base_spans(text):
    text = text or ""
    out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if len(m.group()) >= 16]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text) if len(m.group()) >= 32]
    return sorted(out, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


def kept_bytes(docs, length=100):
    """docs: {number: bytes}. For each the bytes left, the bytes removed and the stretches removed."""
    seen, out = set(), {}
    for doc in sorted(docs):
        data = docs[doc]
        gone = bytearray(len(data))
        fresh = set()
        for at in range(len(data) - length + 1):
            string = data[at:at + length]
            if string in seen or string in fresh:
                gone[at:at + length] = b"\1" * length
            fresh.add(string)
        seen |= fresh
        left = bytes(b for b, g in zip(data, gone) if not g)
        out[doc] = (left, sum(gone), len(re.findall(b"\1+", bytes(gone))))
    return out
