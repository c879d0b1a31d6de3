import pytest

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names that the operators use for their own columns.
CLASH = "key string, code int, size int, label string, spans string, kept int, score string, row int, doc int, slice int, rank int, n_words string, component_id int"


@pytest.fixture(scope="session")
def docs(make):
    """A table of documents from (id, text, lang, source) with columns whose names clash."""
    def build(rows, extra=True):
        extras = tuple(None for _ in CLASH.split(",")) if extra else ()
        full = [(i, t, lang, src, None if t is None else len(t), *extras) for i, t, lang, src in rows]
        return make(full, f"{DOC}, {CLASH}" if extra else DOC)

    return build


def sentence(n, seed=0, size=12):
    """`n` words that look random but are fixed."""
    state, out = seed * 7919 + 17, []
    for _ in range(n):
        state = (state * 1103515245 + 12345) % 2**31
        word, x = "", state
        for _ in range(2 + state // 65536 % (size - 3)):
            x = (x * 69069 + 1) % 2**32
            word += "abcdefghijklmnoprstuvw"[x >> 16 & 15]
        out.append(word)
    return " ".join(out) + "."


ODD = [None, "", " \n\t ", "a", "\x00", "ß😀é", "x" * 50_000, "tick " * 4_000]
