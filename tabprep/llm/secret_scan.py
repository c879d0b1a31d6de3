"""Operator 10, secret scans: regex rules over a trigram inverted index.

Each rule's regex yields a Boolean query of trigrams that every match must contain, as a list of clauses (any clause, all
of its trigrams). The index holds a posting (trigram, document key) for every trigram that some rule asks for, taken
from the lower-cased text. Postings of a clause's trigrams are intersected by counting; a document that satisfies a
clause is a candidate of that rule and is verified by the rule's regex. Rules without mandatory trigrams scan every
text. All of it is DataFrame expressions.

Spans are (kind, start, end) in code points, end exclusive. The base kinds are `assign`, `access` and `hex`; the further
kinds only add spans. Letters in the `assign` keywords match in either ASCII case.

Plan: postings carry a 64-bit hash of id and text, which is all that is shuffled to find candidates; equal hashes can
only add a candidate, never lose one. Candidates join the documents on that hash, which spreads copies by their ids.

Defined cases: a null text counts as empty and has no spans; whole texts are scanned; repeated rows each get their own
result; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.llm.text import let, others, quoted, whole, with_outputs
from tabprep.session import materialise
from tabprep.sizing import local_table

try:
    from re import _constants as sre, _parser as sre_parse
except ImportError:  # Python 3.10
    import sre_constants as sre
    import sre_parse


@dataclass(frozen=True)
class Rule:
    """A kind of secret. `pattern` is read alike by Java and Python; group `group` must have `least` characters.

    `keep` gives how many characters of a match its span takes, all of them where it is absent.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    keep: Callable[[Column], Column] | None = None


# A run of hex digits or an access id that is too short cannot start a longer one, so their least length is in the
# pattern. An assignment with a short value still uses up its characters, so its length is judged after the match.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
)
# A key goes on behind its BEGIN line with headers (Name: value) and a run of what keys hold, up to an END line if one ends the
# run. The run holds no hyphen, so it stops at the next line of this kind and no text is read twice. Breaks may be written as \n.
BEGIN = r"-----BEGIN [A-Z ]*PRIVATE KEY-----"
HEADERS = r"(?:(?:[\x20\t\r\n]|\\[rn]){0,4}[A-Za-z][A-Za-z0-9-]{0,63}:(?:[^\r\n\\-]|-(?!-)){0,200}){0,8}"
END = r"-----END [A-Z ]*PRIVATE KEY-----"
FURTHER = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("private_key", f"{BEGIN}(?:{HEADERS}[A-Za-z0-9+/=\\\\\\x20\\t\\r\\n]*(?:{END})?)?", keep=lambda found: key_length(found)),
)
RULES = BASE + FURTHER

MOST_STRINGS = 64
WIDEST_CLASS = 8


def key_length(found: Column) -> Column:
    """Characters of a private key's match that belong to the key.

    All of them where an END line ends it. Else the BEGIN line, with the headers and the base64 behind it as far as every word
    has 16 characters or more; what follows is other text.
    """
    head = F.regexp_extract(found, f"^{BEGIN}{HEADERS}", 0)
    body = F.regexp_replace(F.substring(found, F.length(head) + 1, F.length(found)), r"\\[rn]", "  ")
    short = F.regexp_instr(body, F.lit("(?<![A-Za-z0-9+/=])[A-Za-z0-9+/=]{1,15}(?![A-Za-z0-9+/=])"))
    long = F.when(short > 0, F.substring(body, F.lit(1), short - 1)).otherwise(body)
    base64 = F.length(F.regexp_extract(long, r"(?s)^.*[A-Za-z0-9+/=]", 0))
    bare = F.length(F.regexp_extract(found, f"^{BEGIN}", 0))
    return F.when(found.endswith("-----") & (F.regexp_count(found, F.lit("-----END ")) > 0), F.length(found)).when(
        base64 > 0, F.length(head) + base64).otherwise(bare)


# Trigram queries -----------------------------------------------------------------------------------------------------

Clauses = frozenset  # of frozensets of trigrams; the empty clause is satisfied by every document
ALWAYS: Clauses = frozenset([frozenset()])


def _simple(clauses) -> Clauses:
    """Drop clauses that contain another one."""
    return frozenset(c for c in clauses if not any(o < c for o in clauses))


def _either(queries) -> Clauses:
    return _simple(frozenset().union(*queries))


def _both(a: Clauses, b: Clauses) -> Clauses:
    if len(a) * len(b) > MOST_STRINGS:  # the shorter one alone is still necessary
        return min(a, b, key=len) if ALWAYS not in (a, b) else (b if a == ALWAYS else a)
    return _simple(frozenset(x | y for x, y in product(a, b)))


def _of_strings(strings) -> Clauses:
    """Any of these strings is in the text."""
    return _simple(frozenset(frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings))


def _class_chars(items) -> set[str] | None:
    """The lower-cased characters of a class, or None when it is negated or wide."""
    chars: set[str] = set()
    for op, value in items:
        if op is sre.LITERAL:
            chars.add(chr(value).lower())
        elif op is sre.RANGE and value[1] - value[0] < WIDEST_CLASS:
            chars.update(chr(c).lower() for c in range(value[0], value[1] + 1))
        else:
            return None
    return chars if len(chars) <= WIDEST_CLASS else None


def _walk(nodes) -> tuple[set[str] | None, Clauses]:
    """(all strings the nodes can match, None if too many; the query of what they must contain)."""
    done, run = ALWAYS, {""}
    exact = True

    def end_run():
        nonlocal done, run, exact
        done, run, exact = _both(done, _of_strings(run)), {""}, False

    for op, value in nodes:
        strings: set[str] | None = None
        must = ALWAYS
        if op is sre.LITERAL:
            strings = {chr(value).lower()}
        elif op is sre.IN:
            strings = _class_chars(value)
        elif op is sre.SUBPATTERN:
            strings, must = _walk(value[-1])
        elif op is sre.BRANCH:
            parts = [_walk(p) for p in value[1]]
            if all(s is not None for s, _ in parts):
                strings = set().union(*[s for s, _ in parts])
            must = _either([m if s is None else _of_strings(s) for s, m in parts])
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            low, high, body = value
            inner, inner_must = _walk(body)
            if (low, high) == (0, 1) and inner is not None:
                strings = inner | {""}
            elif inner is not None and low == high and len(inner) == 1:
                strings = {next(iter(inner)) * low}
            elif low:
                must = inner_must if inner is None else _of_strings(inner)
        elif op is sre.AT:
            continue
        if strings is not None and len(run) * len(strings) <= MOST_STRINGS:
            run = {a + b for a, b in product(run, strings)}
            continue
        end_run()
        if strings is not None and len(strings) <= MOST_STRINGS:
            run = set(strings)
        else:
            done = _both(done, must)
    if exact:
        return run, ALWAYS
    end_run()
    return None, done


def trigram_query(pattern: str) -> Clauses:
    """Clauses of lower-case trigrams, one of which holds in every text that matches; ALWAYS if nothing is mandatory."""
    strings, query = _walk(sre_parse.parse(pattern))
    query = _of_strings(strings) if strings is not None else query
    return ALWAYS if frozenset() in query else query


# Spans ---------------------------------------------------------------------------------------------------------------

CHUNK = 256  # array items handled together
SPANS = "array<struct<kind:string,start:int,end:int>>"


def _chunks(items: Column) -> Column:
    """The array in pieces of CHUNK. Growing an array by one copies it, so long ones are built piece by piece."""
    last = F.floor((F.size(items) - 1) / CHUNK).cast("int")
    return F.when(F.size(items) > 0, F.transform(F.sequence(F.lit(0), last), lambda n: F.slice(items, n * CHUNK + 1, CHUNK))).otherwise(
        F.slice(F.array(items), 1, 0))


def _running(items: Column, start: Column, step: Callable[[Column, Column], Column]) -> Column:
    """Per item (before, item), where `before` is what `step` has made of all items before it."""
    def grow(done: Column, item: Column) -> Column:
        entry = F.struct(done["now"].alias("before"), item.alias("item"))
        return F.struct(step(done["now"], item).alias("now"), F.array_append(done["out"], entry).alias("out"))

    none = F.transform(F.slice(items, 1, 0), lambda x: F.struct(start.alias("before"), x.alias("item")))
    return F.aggregate(items, F.struct(start.alias("now"), none.alias("out")), grow)["out"]


def _located(text: Column, rule: Rule) -> Column:
    """Spans of the leftmost matches that do not overlap: text between matches and matches alternate."""
    matches = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    checked = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else matches
    parts = F.transform(F.arrays_zip(
        F.slice(F.split(text, rule.pattern, -1), 1, F.size(matches)).alias("gap"), matches.alias("match"), checked.alias("checked")),
        lambda p: F.struct(
            F.length(p["gap"]).alias("gap"), F.length(p["match"]).alias("length"),
            (rule.keep(p["match"]) if rule.keep else F.length(p["match"])).alias("kept"),
            (F.length(p["checked"]) >= rule.least).alias("good")))

    def size(done: Column, part: Column) -> Column:
        return done + part["gap"] + part["length"]

    def spans(chunk: Column) -> Column:
        placed = _running(chunk["item"], chunk["before"], size)
        begin = lambda x: x["before"] + x["item"]["gap"]
        return F.transform(F.filter(placed, lambda x: x["item"]["good"]), lambda x: F.struct(
            F.lit(rule.kind).alias("kind"), begin(x).alias("start"), (begin(x) + x["item"]["kept"]).alias("end")))

    # Every array is bound before it is used, or each use would compute it again.
    chunked = let(parts, _chunks)
    starts = let(chunked, lambda c: _running(c, F.lit(0), lambda done, chunk: F.aggregate(chunk, done, size)))
    return F.flatten(F.transform(starts, spans)).cast(SPANS)


def spans_of(text: Column, rule: Rule) -> Column:
    none = F.array().cast(SPANS)
    return F.when(text.rlike(rule.pattern), _located(text, rule)).otherwise(none)


def postings(keyed: DataFrame, key: str, text_col: str, trigrams: Sequence[str]) -> DataFrame:
    """The inverted index for the given trigrams: (trigram, key), each pair once per row."""
    lowered = keyed.select(quoted(key).alias("key"), F.lower(whole(text_col)).alias("low"))
    found = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams]))
    return lowered.select("key", F.explode(found).alias("trigram"))


def candidates(index: DataFrame, queries: dict[str, Clauses]) -> DataFrame:
    """(key, rules): the rules whose query the key's postings satisfy, by intersecting postings clause by clause."""
    spark = index.sparkSession
    wanted, sizes = [], []
    for rule, clauses in queries.items():
        for n, clause in enumerate(sorted(map(sorted, clauses))):
            wanted += [(f"{rule}/{n}", t) for t in clause]
            sizes.append((f"{rule}/{n}", rule, len(clause)))
    # Both tables are as small as the rules.
    asked = F.broadcast(local_table(spark, wanted, "clause string, trigram string"))
    needed = F.broadcast(local_table(spark, sizes, "clause string, rule string, size bigint"))
    met = index.distinct().join(asked, "trigram").groupBy("key", "clause").agg(F.count(F.lit(1)).alias("n"))
    return met.join(needed, "clause").where("n = size").groupBy("key").agg(F.collect_set("rule").alias("rules"))


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] = RULES,
         out: str = "spans") -> DataFrame:
    """Add the spans of all rules, ordered by start, then by the order of `rules`."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {k: q for k, q in queries.items() if q != ALWAYS}
    keyed = with_outputs(df, scan__key=F.xxhash64(quoted(id_col), whole(text_col)))
    if indexed:
        trigrams = sorted(set().union(*[c for q in indexed.values() for c in q]))
        found = materialise(candidates(postings(keyed, "scan__key", text_col, trigrams), indexed))
        keyed = keyed.join(found.withColumnsRenamed({"key": "scan__key", "rules": "scan__rules"}), "scan__key", "left")
    else:
        keyed = keyed.withColumn("scan__rules", F.array().cast("array<string>"))
    text, none = whole(text_col), F.array().cast(SPANS)
    named = F.coalesce("scan__rules", F.array().cast("array<string>"))
    each = [
        spans_of(text, r) if r.kind not in indexed else F.when(F.array_contains(named, r.kind), spans_of(text, r)).otherwise(none)
        for r in rules
    ]
    ordered = let(F.flatten(F.array(*each)), lambda spans: F.transform(
        F.array_sort(F.transform(spans, lambda x: F.struct(
            x["start"].alias("start"),
            F.array_position(F.array(*[F.lit(r.kind) for r in rules]), x["kind"]).alias("place"),
            x["end"].alias("end"), x["kind"].alias("kind")))),
        lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))))
    return keyed.select(*others(df, [out]), ordered.cast(SPANS).alias(out))


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("bigint")


def redact(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] = RULES,
           mark: str = "[secret]") -> DataFrame:
    """Every span replaced by `mark` (overlapping spans by one); columns as in `df`, `n_chars` follows the text."""
    scanned = find(df, id_col, text_col, rules, out="scan__spans")
    text = whole(text_col)

    def reach(done: Column, span: Column) -> Column:
        return F.greatest(done, span["end"])

    def rewritten(chunk: Column) -> Column:
        """The text from the end of the spans before a chunk to the end of its own, which alone is walked through."""
        first, end = chunk["before"], F.aggregate(chunk["item"], chunk["before"], reach)

        def cut(part: Column) -> Column:
            pieces = F.transform(_running(chunk["item"], first, reach), lambda x: F.when(
                x["item"]["start"] < x["before"], F.lit("")).otherwise(F.concat(
                    F.substring(part, x["before"] - first + 1, x["item"]["start"] - x["before"]), F.lit(mark))))
            return F.array_join(pieces, "")

        return let(F.substring(text, first + 1, end - first), cut)

    chunks = let(_chunks(F.col("scan__spans")), lambda c: _running(c, F.lit(0), lambda done, chunk: F.aggregate(chunk, done, reach)))
    last = F.aggregate("scan__spans", F.lit(0), reach)
    rebuilt = F.concat(F.array_join(F.transform(chunks, rewritten), ""), F.substring(text, last + 1, F.length(text)))
    changed = scanned.withColumn("scan__new", F.when(F.size("scan__spans") > 0, rebuilt))
    new = {text_col: F.coalesce(F.col("scan__new"), quoted(text_col))}
    if "n_chars" in df.columns and text_col == "text":
        new["n_chars"] = F.coalesce(F.length("scan__new").cast("bigint"), quoted("n_chars"))
    return changed.select(*[(new[c] if c in new else quoted(c)).alias(c) for c in df.columns])
