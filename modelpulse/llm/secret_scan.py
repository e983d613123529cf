"""Secret scan: all rules as one deterministic automaton over bytes.

Rules are regular expressions of ASCII characters. Together they become one nondeterministic automaton, by subset
construction a deterministic one, and by partition refinement the smallest one that tells the same: an array
``next[state + class of the byte]``. A task reads every byte of a text once and learns where which rules may first end.

Where a rule ends, its own two automata say from where to where. The one of the reversed rule runs backwards over the
stretch of characters that the rule can hold at all and marks every start of a match; the anchored one runs from the
first mark to the longest end, and then from the first mark after it. So matches are the leftmost ones, as long as
possible and without overlap in their kind, and the work is linear in the text whatever it holds.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from modelpulse.llm.registry import query
from modelpulse.llm.text import bounded_batches, documents


@dataclass(frozen=True)
class Rule:
    """Matches of ``head`` and ``tail`` in a row; those whose tail is shorter than ``least`` are dropped when found.

    Patterns hold literals, sets, groups, ``|``, ``?``, ``*``, ``+``, ``{m}``, ``{m,}``, ``{m,n}`` and the escapes
    ``\\xNN`` and ``\\`` before a sign. With ``any_case`` the letters of the head stand for both cases. The tail
    begins where the longest head ends, and no match is empty.
    """

    kind: str
    head: str
    tail: str
    least: int = 0
    any_case: bool = False


# The three base kinds.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""", "[A-Za-z0-9+/_.=-]+", 6, True),
    Rule("access", "AKIA", "[A-Z0-9]+", 16),
    Rule("hex", "", "[0-9a-f]{24,}"),
)
RULES = BASE + (
    Rule("private_key", "-----BEGIN ", "(RSA |DSA |EC |OPENSSH |ENCRYPTED |PGP )?PRIVATE KEY( BLOCK)?-----"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]+\.eyJ", r"[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    Rule("github", "gh[oprsu]_", "[A-Za-z0-9]+", 36),
    Rule("github_fine", "github_pat_", "[A-Za-z0-9_]+", 22),
    Rule("gitlab", "glpat-", "[A-Za-z0-9_-]+", 20),
    Rule("slack", "xox[abeoprs]-", "[A-Za-z0-9-]+", 10),
    Rule("slack_hook", r"hooks\.slack\.com/services/", "[A-Za-z0-9/]+", 20),
    Rule("google", "AIza", "[A-Za-z0-9_-]+", 35),
    Rule("stripe", "[rs]k_(live|test)_", "[A-Za-z0-9]+", 16),
    Rule("npm", "npm_", "[A-Za-z0-9]+", 36),
    Rule("sendgrid", r"SG\.[A-Za-z0-9_-]+\.", "[A-Za-z0-9_-]+", 20),
    Rule("bearer", r"bearer\x20+", "[A-Za-z0-9+/_.=~-]+", 20, True),
)

_ALL = (1 << 256) - 1
_SPANS = ArrayType(StructType([StructField("kind", StringType()), StructField("start", LongType()), StructField("end", LongType())]))


def parse(pattern: str, any_case: bool = False):
    """The pattern as a tree of ("set", bits of bytes), ("seq", parts), ("alt", parts), ("rep", part, least, most)."""
    at = 0

    def bits(char: str) -> int:
        both = {char.lower(), char.upper()} if any_case and char.isalpha() else {char}
        return sum(1 << ord(c) for c in both)

    def literal() -> str:
        nonlocal at
        char = pattern[at]
        at += 1
        if char != "\\":
            return char
        if pattern[at] == "x":
            at += 3
            return chr(int(pattern[at - 2 : at], 16))
        at += 1
        return pattern[at - 1]

    def characters() -> int:
        nonlocal at
        negated, found = pattern[at] == "^", 0
        at += negated
        while pattern[at] != "]":
            first = literal()
            last = first
            if pattern[at] == "-" and pattern[at + 1] != "]":
                at += 1
                last = literal()
            for code in range(ord(first), ord(last) + 1):
                found |= bits(chr(code))
        at += 1
        return _ALL & ~found if negated else found

    def atom():
        nonlocal at
        if pattern[at] == "(":
            at += 1
            inner = branches()
            at += 1
            return inner
        if pattern[at] == "[":
            at += 1
            return "set", characters()
        return "set", bits(literal())

    def repeated(part):
        nonlocal at
        if pattern[at] == "{":
            end = pattern.index("}", at)
            least, comma, most = pattern[at + 1 : end].partition(",")
            at = end + 1
            return "rep", part, int(least), int(most) if most else None if comma else int(least)
        least, most = {"?": (0, 1), "*": (0, None), "+": (1, None)}[pattern[at]]
        at += 1
        return "rep", part, least, most

    def sequence():
        parts = []
        while at < len(pattern) and pattern[at] not in "|)":
            part = atom()
            if at < len(pattern) and pattern[at] in "?*+{":
                part = repeated(part)
            parts.append(part)
        return "seq", parts

    def branches():
        nonlocal at
        parts = [sequence()]
        while at < len(pattern) and pattern[at] == "|":
            at += 1
            parts.append(sequence())
        return "alt", parts

    tree = branches()
    if at < len(pattern):
        raise ValueError(f"unexpected {pattern[at]!r} at {at} of {pattern!r}")
    return tree


def reverse(tree):
    if tree[0] == "set":
        return tree
    if tree[0] == "rep":
        return "rep", reverse(tree[1]), *tree[2:]
    parts = [reverse(p) for p in tree[1]]
    return tree[0], parts[::-1] if tree[0] == "seq" else parts


def shortest(tree):
    """The tree without what may go on once a match is complete: every match of ``tree`` begins with one of it."""
    if tree[0] == "rep":
        return "rep", tree[1], tree[2], tree[2]
    if tree[0] == "seq" and tree[1]:
        return "seq", [*tree[1][:-1], shortest(tree[1][-1])]
    return ("alt", [shortest(p) for p in tree[1]]) if tree[0] == "alt" else tree


def alphabet(tree) -> int:
    """The bytes that a match can hold."""
    if tree[0] == "set":
        return tree[1]
    found = 0
    for part in [tree[1]] if tree[0] == "rep" else tree[1]:
        found |= alphabet(part)
    return found


class _Nondeterministic:
    """States with free moves and moves by sets of bytes."""

    def __init__(self):
        self.free: list[list[int]] = []
        self.moves: list[list[tuple[int, int]]] = []

    def state(self) -> int:
        self.free.append([])
        self.moves.append([])
        return len(self.free) - 1

    def add(self, tree, start: int) -> int:
        """The state reached by a match of ``tree`` from ``start``."""
        if tree[0] == "set":
            end = self.state()
            self.moves[start].append((tree[1], end))
            return end
        if tree[0] == "seq":
            for part in tree[1]:
                start = self.add(part, start)
            return start
        if tree[0] == "alt":
            end = self.state()
            for part in tree[1]:
                entry = self.state()
                self.free[start].append(entry)
                self.free[self.add(part, entry)].append(end)
            return end
        _, part, least, most = tree
        for _ in range(least):
            start = self.add(part, start)
        if most is None:
            loop = self.state()
            self.free[start].append(loop)
            self.free[self.add(part, loop)].append(loop)
            return loop
        end = self.state()
        self.free[start].append(end)
        for _ in range(most - least):
            start = self.add(part, start)
            self.free[start].append(end)
        return end

    def closure(self, states) -> frozenset[int]:
        found, todo = set(states), list(states)
        while todo:
            for other in self.free[todo.pop()]:
                if other not in found:
                    found.add(other)
                    todo.append(other)
        return frozenset(found)


class Automaton:
    """The smallest deterministic automaton of some trees.

    ``classes`` maps a byte to its class, ``next[state + class]`` is the next state (states are multiples of the
    number of classes), states from ``final`` on accept, and ``accepts[state]`` are the trees that end there.
    Unless ``anchored``, a match may begin at any byte. ``dead`` is the state that nothing leaves, if there is one.
    """

    def __init__(self, trees: Sequence, anchored: bool):
        machine = _Nondeterministic()
        start = machine.state()
        ends = {}
        for i, tree in enumerate(trees):
            entry = machine.state()
            machine.free[start].append(entry)
            ends[machine.add(tree, entry)] = i
        # Bytes that every set treats alike are one class.
        sets = sorted({bits for moves in machine.moves for bits, _ in moves})
        kinds: dict[tuple[bool, ...], int] = {}
        self.classes = bytes(kinds.setdefault(tuple(bool(s >> b & 1) for s in sets), len(kinds)) for b in range(256))
        width = len(kinds)
        sample = [self.classes.index(c) for c in range(width)]
        # Subset construction.
        origin = machine.closure([start])
        number, todo, table = {origin: 0}, [origin], []
        for subset in todo:
            row = []
            moves = [m for state in subset for m in machine.moves[state]]
            for byte in sample:
                goal = {target for bits, target in moves if bits >> byte & 1}
                if not anchored:
                    goal.add(start)
                reached = machine.closure(goal)
                if reached not in number:
                    number[reached] = len(number)
                    todo.append(reached)
                row.append(number[reached])
            table.append(row)
        accepted = [tuple(sorted(ends[s] for s in subset if s in ends)) for subset in todo]
        # Minimisation: states stay together as long as their successors do.
        moves = np.array(table, dtype=np.int64)
        _, group = np.unique([str(a) for a in accepted], return_inverse=True)
        while True:
            _, finer = np.unique(np.column_stack([group, group[moves]]), axis=0, return_inverse=True)
            finer = finer.ravel()
            if finer.max() == group.max():
                break
            group = finer
        # Numbered so that the start comes first and accepting states last.
        one = {g: i for i, g in reversed(list(enumerate(group)))}
        order = sorted(one, key=lambda g: (bool(accepted[one[g]]), one[g]))
        place = {g: i for i, g in enumerate(order)}
        new = np.array([place[g] for g in group])
        self.width, self.start = width, int(new[0]) * width
        self.next = (new[moves[[one[g] for g in order]]] * width).ravel().tolist()
        self.final = width * next((i for i, g in enumerate(order) if accepted[one[g]]), len(order))
        self.accepts = {i * width: accepted[one[g]] for i, g in enumerate(order) if accepted[one[g]]}
        dead = [i * width for i in range(len(order)) if i * width < self.final and set(self.next[i * width : (i + 1) * width]) == {i * width}]
        self.dead = dead[0] if dead else -1

    def __len__(self) -> int:
        return len(self.next) // self.width

    def longest(self, classes: bytes, at: int) -> int:
        """The end of the longest match from ``at``, or -1."""
        move, state, final, dead = self.next, self.start, self.final, self.dead
        end = at if state >= final else -1
        for i in range(at, len(classes)):
            state = move[state + classes[i]]
            if state >= final:
                end = i + 1
            elif state == dead:
                break
        return end


class Locator:
    """Where the matches of one rule lie."""

    def __init__(self, rule: Rule):
        head, tail = parse(rule.head, rule.any_case), parse(rule.tail)
        whole = "seq", [head, tail]
        self.least = rule.least
        self.head = Automaton([head], True)
        self.forwards = Automaton([whole], True)
        self.backwards = Automaton([reverse(whole)], False)
        held = alphabet(whole)
        # 1 for bytes that no match holds.
        self.outside = bytes(not held >> b & 1 for b in range(256))

    def around(self, outside: bytes, at: int) -> tuple[int, int]:
        """The stretch around ``at`` that matches are confined to."""
        end = outside.find(1, at)
        return outside.rfind(1, 0, at) + 1, len(outside) if end < 0 else end

    def matches(self, stretch: bytes) -> list[tuple[int, int]]:
        back = self.backwards
        move, state, final, starts = back.next, back.start, back.final, []
        for i, c in enumerate(reversed(stretch.translate(back.classes))):
            state = move[state + c]
            if state >= final:
                starts.append(len(stretch) - 1 - i)
        found, upto = [], 0
        forwards, heads = stretch.translate(self.forwards.classes), stretch.translate(self.head.classes)
        for start in reversed(starts):
            if start < upto:
                continue
            upto = self.forwards.longest(forwards, start)
            if upto - self.head.longest(heads, start) >= self.least:
                found.append((start, upto))
        return found


class Scanner:
    """All rules over a text in one pass."""

    def __init__(self, rules: Sequence[Rule]):
        self.kinds = [r.kind for r in rules]
        # Where a match may end for the first time is all that the pass must tell. What follows would only
        # multiply the states, as each rule's run could go on beside all others.
        trees = [shortest(("seq", [parse(r.head, r.any_case), parse(r.tail)])) for r in rules]
        self.automaton = Automaton(trees, False)
        self.locators = [Locator(r) for r in rules]

    def spans(self, text: str | None) -> list[tuple[int, int, int]]:
        """Start, number of the rule and end of every match, in this order; code points."""
        if not text:
            return []
        data = text.encode("utf-8", "surrogatepass")
        found: list[tuple[int, int, int]] = []
        done, outside = [0] * len(self.kinds), {}
        every = self.automaton
        move, state, final, accepts = every.next, every.start, every.final, every.accepts
        for i, c in enumerate(data.translate(every.classes)):
            state = move[state + c]
            if state >= final:
                for rule in accepts[state]:
                    if i >= done[rule]:
                        locator = self.locators[rule]
                        if rule not in outside:
                            outside[rule] = data.translate(locator.outside)
                        low, done[rule] = locator.around(outside[rule], i)
                        found += [(low + a, rule, low + b) for a, b in locator.matches(data[low : done[rule]])]
        found.sort()
        if len(data) == len(text) or not found:
            return found
        return _code_points(data, found)


def _code_points(data: bytes, found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The same places counted in code points."""
    points, at, n = {}, 0, 0
    for place in sorted({x for start, _, end in found for x in (start, end)}):
        n += len(data[at:place].decode("utf-8", "surrogatepass"))
        points[place], at = n, place
    return [(points[a], rule, points[b]) for a, rule, b in found]


@lru_cache(maxsize=8)
def scanner(rules: tuple[Rule, ...] = RULES) -> Scanner:
    return Scanner(rules)


def find_secrets(docs: DataFrame, text_col: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """All rows and columns of ``docs`` and ``secrets``, an array of (``kind``, ``start``, ``end``) by start, then by the order of the rules.

    Places are code points of the whole text, the end is exclusive. A null or empty text has no secrets (an empty
    array). Every row is scanned by itself, so repeated rows and null ids need no case of their own. A column of the
    input named ``secrets`` is replaced.
    """
    bounded_batches(docs.sparkSession)
    names = [c for c in docs.columns if c != "secrets"]
    machine = scanner(tuple(rules))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.struct_field(batch.column(0), text_col).to_pylist()
            secrets = [[{"kind": machine.kinds[r], "start": a, "end": b} for a, r, b in machine.spans(t)] for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(secrets, kind)], names=["_doc", "secrets"])

    # The row travels as one column, so that none of its names can clash.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_doc"))
    # Taken from the rows' own type, since names may hold signs that a written schema can't.
    schema = StructType([rows.schema["_doc"], StructField("secrets", _SPANS)])
    out = rows.mapInArrow(work, schema)
    return out.select(*[F.col("_doc").getField(c).alias(c) for c in names], "secrets")


@query()
def op13_secret_scan(spark, sf_dir):
    found = find_secrets(documents(spark, sf_dir).select("doc_id", "text"))
    base = F.filter("secrets", lambda s: s["kind"].isin([r.kind for r in BASE]))
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id",
        *[count(r.kind).alias(f"n_{r.kind}") for r in BASE],
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("secrets")).alias("spans"),
    )
