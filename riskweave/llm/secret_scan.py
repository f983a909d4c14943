"""Secrets in text, found by one automaton for all rules.

Every rule is a regular expression over ASCII, in two parts: a head that leads to the secret and a body
that is the secret.  All rules together are read backwards: their reversed expressions become one
nondeterministic automaton, made deterministic by subset construction and minimised, with the bytes
folded into classes.  Its transitions are one array, and one pass from the last byte to the first tells,
for every place and rule, whether a match starts there.  The pass runs over many stretches of a block at
once; a stretch that began in the wrong state is run again until it meets the states of its first pass,
so the result does not depend on where a block was cut.

Only at these places the forward automata of the rule walk on to the longest end.  Matches of one rule
are taken from left to right and do not overlap; a match whose body is too short is dropped after it has
taken its place.  For the rules below the longest match is the greedy one.

Texts are scanned whole, in blocks inside the tasks; nothing is shuffled.  Null and empty texts have no
spans.  Repeated rows give equal results, rules that match at the same place are listed in rule order, an
empty table gives no row.  Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from riskweave.llm.common import byte_blocks, id_text

BLOCK = 1_000_000  # bytes scanned at once
STRETCH = 256  # bytes of one stretch of a block, at least
BREAK = 0xFF  # between texts: never a byte of UTF-8, ends every match
SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


@dataclass(frozen=True)
class Rule:
    """``head`` and ``body`` are expressions with groups, ``|``, ``?``, ``*``, ``+``, ``{m,n}`` and ASCII classes."""

    kind: str
    head: str
    body: str
    least: int = 1  # characters of the body
    either_case: bool = False


# fixed values: the wanted kinds, in the order of their listing; 16 hexadecimal digits are counted by the automaton
RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""", r"[A-Za-z0-9+/_.=-]+", 12, True),
    Rule("access", r"AKIA", r"[A-Z0-9]+", 14),
    Rule("hex", r"", r"[0-9a-f]{16,}", 16),
)
# fixed values: published formats of further secrets
MORE_RULES = (
    Rule("github", r"gh[opsru]_", r"[A-Za-z0-9]+", 36),
    Rule("slack", r"xox[abeprs]-", r"[A-Za-z0-9-]+", 10),
    Rule("stripe", r"[rs]k_live_", r"[A-Za-z0-9]+", 16),
    Rule("google", r"AIza", r"[A-Za-z0-9_-]+", 35),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.", r"[A-Za-z0-9_-]+", 10),
    Rule("private_key", r"-----BEGIN ([A-Z]+ )*PRIVATE KEY", r"-----", 5),
)

# --- expressions ------------------------------------------------------------------------------------
# A tree is ("set", bytes), ("all", parts), ("any", parts) or ("many", part, least, most).


class _Reader:
    """A tree from an expression."""

    def __init__(self, text: str, either_case: bool):
        self.text, self.at, self.either_case = text, 0, either_case

    def tree(self) -> tuple:
        found = self._choice()
        if self.at < len(self.text):
            raise ValueError(f"not understood: {self.text[self.at:]!r}")
        return found

    def _next(self, wanted: str) -> bool:
        if self.text[self.at : self.at + 1] != wanted:
            return False
        self.at += 1
        return True

    def _choice(self) -> tuple:
        parts = [self._sequence()]
        while self._next("|"):
            parts.append(self._sequence())
        return parts[0] if len(parts) == 1 else ("any", parts)

    def _sequence(self) -> tuple:
        parts = []
        while self.at < len(self.text) and self.text[self.at] not in "|)":
            parts.append(self._repeated(self._atom()))
        return ("all", parts)

    def _atom(self) -> tuple:
        if self._next("("):
            inner = self._choice()
            if not self._next(")"):
                raise ValueError("a group is not closed")
            return inner
        if self._next("["):
            return ("set", self._class())
        return ("set", self._cased({self._byte()}))

    def _byte(self) -> int:
        c = self.text[self.at]
        self.at += 1
        if c == "\\":
            c = self.text[self.at]
            self.at += 1
            if c == "x":
                self.at += 2
                return int(self.text[self.at - 2 : self.at], 16)
            if c.isalnum():
                raise ValueError(f"escape \\{c} is not understood")
        if ord(c) > 0x7F:
            raise ValueError("rules are ASCII")
        return ord(c)

    def _class(self) -> frozenset[int]:
        out: set[int] = set()
        outside = self._next("^")
        while not self._next("]"):
            low = self._byte()
            high = low
            if self.text[self.at] == "-" and self.text[self.at + 1] != "]":
                self.at += 1
                high = self._byte()
            out.update(range(low, high + 1))
        out = self._cased(out)
        return frozenset(range(0x80)) - out if outside else out

    def _cased(self, wanted: set[int]) -> frozenset[int]:
        if not self.either_case:
            return frozenset(wanted)
        return frozenset(x for b in wanted for x in chr(b).lower().encode() + chr(b).upper().encode())

    def _repeated(self, part: tuple) -> tuple:
        if self._next("?"):
            return ("many", part, 0, 1)
        if self._next("*"):
            return ("many", part, 0, None)
        if self._next("+"):
            return ("many", part, 1, None)
        if self._next("{"):
            low, comma, high = self.text[self.at : self.text.index("}", self.at)].partition(",")
            self.at = self.text.index("}", self.at) + 1
            return ("many", part, int(low), (int(high) if high else None) if comma else int(low))
        return part


def _mirrored(tree: tuple) -> tuple:
    if tree[0] == "set":
        return tree
    if tree[0] == "many":
        return ("many", _mirrored(tree[1]), *tree[2:])
    parts = [_mirrored(p) for p in tree[1]]
    return (tree[0], parts[::-1] if tree[0] == "all" else parts)


class _Net:
    """A nondeterministic automaton: byte steps and empty steps between numbered places."""

    def __init__(self) -> None:
        self.steps: list[list[tuple[frozenset[int], int]]] = []
        self.empty: list[list[int]] = []

    def place(self) -> int:
        self.steps.append([])
        self.empty.append([])
        return len(self.steps) - 1

    def add(self, tree: tuple, start: int) -> int:
        """The place reached from ``start`` behind ``tree``."""
        if tree[0] == "set":
            end = self.place()
            self.steps[start].append((tree[1], end))
            return end
        if tree[0] == "all":
            for part in tree[1]:
                start = self.add(part, start)
            return start
        end = self.place()
        if tree[0] == "any":
            for part in tree[1]:
                self.empty[self.add(part, start)].append(end)
            return end
        _, part, least, most = tree
        for _ in range(least):
            start = self.add(part, start)
        if most is None:
            loop = self.place()
            self.empty[start].append(loop)
            self.empty[self.add(part, loop)].append(loop)
            self.empty[loop].append(end)
            return end
        self.empty[start].append(end)
        for _ in range(most - least):
            start = self.add(part, start)
            self.empty[start].append(end)
        return end

    def closed(self, places: set[int]) -> frozenset[int]:
        todo, seen = list(places), set(places)
        while todo:
            for x in self.empty[todo.pop()]:
                if x not in seen:
                    seen.add(x)
                    todo.append(x)
        return frozenset(seen)


@dataclass(frozen=True)
class Automaton:
    """Deterministic and minimal; states are numbered so that the accepting ones come last."""

    byte_class: np.ndarray  # of 256 bytes
    table: np.ndarray  # states x classes: next state
    accepts: np.ndarray  # bit mask of the rules that each state accepts
    start: int
    first_accepting: int


def _deterministic(net: _Net, starts: set[int], ends: list[int], searching: bool) -> Automaton:
    """Subset construction, then merging of states that no continuation tells apart.

    ``searching``: a match may begin at every byte, so the starts are part of every state.
    """
    sets = sorted({s for steps in net.steps for s, _ in steps}, key=sorted)
    marks = np.array([[b in s for s in sets] for b in range(256)], dtype=np.uint8).reshape(256, -1)
    _, sample, byte_class = np.unique(marks, axis=0, return_index=True, return_inverse=True)
    begin = net.closed(starts)
    number, rows, order = {begin: 0}, [], [begin]
    for state in order:
        row = []
        for byte in sample.tolist():
            target = {t for p in state for s, t in net.steps[p] if byte in s}
            reached = net.closed(target | starts if searching else target)
            if reached not in number:
                number[reached] = len(order)
                order.append(reached)
            row.append(number[reached])
        rows.append(row)
    table = np.array(rows, dtype=np.int64)
    accepts = np.array([sum(1 << k for k, end in enumerate(ends) if end in state) for state in order], dtype=np.int64)
    group = np.unique(accepts, return_inverse=True)[1]
    while True:
        finer = np.unique(np.column_stack([group, group[table]]), axis=0, return_inverse=True)[1].ravel()
        if finer.max() == group.max():
            break
        group = finer
    first = np.unique(group, return_index=True)[1]
    rank = np.argsort(accepts[first] != 0, kind="stable")
    renamed = np.argsort(rank)
    merged = accepts[first][rank]
    return Automaton(byte_class.ravel().astype(np.uint8), renamed[group[table[first]]][rank], merged, int(renamed[group[0]]), int((merged == 0).sum()))


@dataclass(frozen=True)
class Scanner:
    rules: tuple[Rule, ...]
    backward: Automaton  # all rules reversed
    heads: tuple[Automaton, ...]
    wholes: tuple[Automaton, ...]


def compiled(rules: tuple[Rule, ...]) -> Scanner:
    """The automata of ``rules``: one for the pass over all bytes, two small ones a rule for the ends."""
    if not rules or len(rules) > 62:
        raise ValueError("1 to 62 rules")
    trees = [(_Reader(r.head, r.either_case).tree(), _Reader(r.body, r.either_case).tree()) for r in rules]
    net, starts, ends = _Net(), set(), []
    for head, body in trees:
        starts.add(start := net.place())
        ends.append(net.add(_mirrored(("all", [head, body])), start))
    if any(end in net.closed(starts) for end in ends):
        raise ValueError("a rule must not match the empty text")

    def forward(tree: tuple) -> Automaton:
        own = _Net()
        start = own.place()
        return _deterministic(own, {start}, [own.add(tree, start)], False)

    return Scanner(
        tuple(rules), _deterministic(net, starts, ends, True),
        tuple(forward(h) for h, _ in trees), tuple(forward(("all", [h, b])) for h, b in trees),
    )


# --- scanning ---------------------------------------------------------------------------------------


def match_starts(data: np.ndarray, automaton: Automaton, stretch: int = STRETCH) -> tuple[np.ndarray, np.ndarray]:
    """(places, bit masks of rules) where matches start, ascending; ``data`` are bytes."""
    n = len(data)
    if not n:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    width = max(stretch, int(np.sqrt(n) // 4))
    lanes = -(-n // width)
    classes = automaton.table.shape[1]
    padded = np.full(lanes * width, automaton.byte_class[BREAK], dtype=np.uint8)
    padded[:n] = automaton.byte_class[data]
    columns = np.ascontiguousarray(padded.reshape(lanes, width).T)
    following = (automaton.table * classes).astype(np.int32).ravel()  # a state is named by its row's offset
    states = np.empty((width, lanes), dtype=np.int32)
    begin = automaton.start * classes
    now, index = np.full(lanes, begin, dtype=np.int32), np.empty(lanes, dtype=np.intp)
    for j in range(width - 1, -1, -1):
        np.add(now, columns[j], out=index)
        np.take(following, index, out=states[j], mode="clip")
        now = states[j]
    assumed = np.full(lanes, begin, dtype=np.int32)
    while True:
        given = np.append(states[0, 1:], np.int32(begin))  # a stretch goes on from the one to its right
        wrong = np.flatnonzero(given != assumed)
        if not len(wrong):
            break
        assumed[wrong] = given[wrong]
        now = given[wrong]
        for j in range(width - 1, -1, -1):
            now = following[now + columns[j, wrong]]
            differs = now != states[j, wrong]
            wrong, now = wrong[differs], now[differs]
            if not len(wrong):
                break
            states[j, wrong] = now
    j, lane = np.nonzero(states >= automaton.first_accepting * classes)
    place = lane * width + j
    order = np.argsort(place)
    return place[order], automaton.accepts[states[j, lane] // classes][order]


def _walker(automaton: Automaton):
    """A function from (bytes, place) to the longest end of a match from that place, or -1."""
    table, byte_class, accepts = automaton.table.tolist(), automaton.byte_class.tolist(), (automaton.accepts != 0).tolist()
    alive = _alive(automaton).tolist()

    def longest(data: bytes, at: int) -> int:
        state, end = automaton.start, at if accepts[automaton.start] else -1
        for i in range(at, len(data)):
            state = table[state][byte_class[data[i]]]
            if accepts[state]:
                end = i + 1
            elif not alive[state]:
                break
        return end

    return longest


def _alive(automaton: Automaton) -> np.ndarray:
    """Whether an accepting state can still be reached."""
    alive = automaton.accepts != 0
    while True:
        more = alive | alive[automaton.table].any(axis=1)
        if (more == alive).all():
            return alive
        alive = more


def spans_of(data: np.ndarray, scanner: Scanner) -> list[tuple[int, int, int]]:
    """(start, rule, end) of all matches in bytes, by start, then rule."""
    place, rules = match_starts(data, scanner.backward)
    found = []
    if len(place):
        whole = data.tobytes()
        for k, rule in enumerate(scanner.rules):
            starts = place[(rules >> k) & 1 == 1]
            if not len(starts):
                continue
            head, all_of_it = _walker(scanner.heads[k]), _walker(scanner.wholes[k])
            i = 0
            while i < len(starts):
                start = int(starts[i])
                end = all_of_it(whole, start)
                if end - head(whole, start) >= rule.least:
                    found.append((start, k, end))
                i = i + 1 if i + 1 < len(starts) and starts[i + 1] >= end else int(np.searchsorted(starts, end))
    return sorted(found)


def scan_secrets(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES + MORE_RULES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, spans) for every row: ``spans`` are (kind, start, end) in code points, by start, then rule order."""
    rows = id_text(docs, id_col, text_col)
    kind = rows.schema["_id"].dataType.simpleString()
    scanner = compiled(rules)
    names = np.array([r.kind for r in rules], dtype=object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, data, offsets in byte_blocks(batches, "_text", BLOCK):
            count = np.arange(block.num_rows)
            spaced = np.insert(data, offsets[1:], BREAK)
            begin = offsets[:-1] + count
            spans = np.array(spans_of(spaced, scanner), dtype=np.int64).reshape(-1, 3)
            edge = np.searchsorted(spans[:, 0], np.append(begin, len(spaced)))
            if len(spans):
                points = np.concatenate(([0], np.cumsum((spaced & 0xC0) != 0x80)))
                base = np.repeat(points[begin], np.diff(edge))
                spans[:, 0], spans[:, 2] = points[spans[:, 0]] - base, points[spans[:, 2]] - base
            listed = pa.ListArray.from_arrays(
                pa.array(edge, pa.int32()),
                pa.StructArray.from_arrays(
                    [pa.array(names[spans[:, 1]], pa.string()), pa.array(spans[:, 0]), pa.array(spans[:, 2])], fields=list(SPAN)
                ),
            )
            yield pa.RecordBatch.from_arrays([block.column("_id"), listed], [id_col, "spans"])

    return rows.mapInArrow(run, f"`{id_col}` {kind}, spans array<struct<kind:string,start:long,end:long>>")
