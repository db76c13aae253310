"""Weighted finite-state transducers over the tropical semiring (min, +).

A ``Machine`` has states, and arcs that read a symbol or nothing, write a
symbol or nothing, and weigh something. Symbols are ints: the ids of a model's
pieces as they are, a character as LONE + its code point (see ``bpe``).
``compose`` builds the composition of two machines once; ``Search`` composes
the result lazily with an input text and with a language model over what is
written, and takes the shortest path.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from roadlens.llm.bpe import LONE, SPACE_MARK

NOTHING, SAME = -2, -1
#: The language model's state before the first symbol.
BEGIN = 0
INFINITY = math.inf

Arc = tuple[int, float, int]


class Machine:
    """State 0 is the start. Per state: one arc at most for a symbol, one for all
    symbols without an arc of their own (``rest``, which writes SAME), any number
    that read nothing."""

    def __init__(self):
        self.arcs: list[dict[int, Arc]] = []
        self.rest: list[Arc | None] = []
        self.silent: list[list[Arc]] = []

    def state(self) -> int:
        self.arcs.append({})
        self.rest.append(None)
        self.silent.append([])
        return len(self.arcs) - 1

    def step(self, state: int, symbol: int) -> Arc | None:
        """The arc that reads a symbol, with what it writes."""
        arc = self.arcs[state].get(symbol)
        if arc is None:
            arc = self.rest[state]
        return (symbol, *arc[1:]) if arc is not None and arc[0] == SAME else arc


def normaliser(add_prefix: bool) -> Machine:
    """Writes a mark before all else, if asked to; a space becomes the mark, every other character stays."""
    made, mark = Machine(), LONE + ord(SPACE_MARK)
    start = made.state()
    inside = made.state() if add_prefix else start
    if add_prefix:
        made.silent[start].append((mark, 0.0, inside))
    made.arcs[inside][LONE + ord(" ")] = (mark, 0.0, inside)
    made.rest[inside] = (SAME, 0.0, inside)
    return made


def spelling_machine(pieces: Iterable[tuple[str, int]]) -> Machine:
    """Reads the characters of a piece one by one and then writes its id. A
    character that is no piece is written as it is: the byte fallback's arc."""
    made = Machine()
    root = made.state()
    made.rest[root] = (SAME, 0.0, root)
    for piece, number in pieces:
        state = root
        for c in piece:
            arc = made.arcs[state].get(LONE + ord(c))
            if arc is None:
                arc = made.arcs[state][LONE + ord(c)] = (NOTHING, 0.0, made.state())
            state = arc[2]
        made.silent[state].append((number, 0.0, root))
    for symbol, (_, _, state) in made.arcs[root].items():
        if not made.silent[state]:
            made.silent[state].append((symbol, 0.0, root))
    return made


def compose(first: Machine, second: Machine) -> Machine:
    """What ``second`` makes of what ``first`` writes. Only pairs of states that can be reached are built."""
    made = Machine()
    number = {(0, 0): made.state()}
    pairs = [(0, 0)]

    def at(p: int, q: int) -> int:
        if (p, q) not in number:
            number[p, q] = made.state()
            pairs.append((p, q))
        return number[p, q]

    def through(arc: Arc, q: int) -> Arc | None:
        out, weight, p = arc
        if out == NOTHING:
            return NOTHING, weight, at(p, q)
        hit = second.step(q, out)
        return hit and (hit[0], weight + hit[1], at(p, hit[2]))

    for p, q in pairs:  # grows
        here = number[p, q]
        made.silent[here] += [arc for arc in (through(a, q) for a in first.silent[p]) if arc]
        made.silent[here] += [(out, weight, at(p, to)) for out, weight, to in second.silent[q]]
        for symbol, arc in first.arcs[p].items():
            if hit := through(arc, q):
                made.arcs[here][symbol] = hit
        if copying := first.rest[p]:
            _, weight, to = copying
            for symbol, (out, more, state) in second.arcs[q].items():
                if symbol not in first.arcs[p]:
                    made.arcs[here][symbol] = (out, weight + more, at(to, state))
            if lone := second.rest[q]:
                made.rest[here] = (lone[0], weight + lone[1], at(to, lone[2]))
    return made


class Search:
    """Shortest paths through text o machine o language model, built lazily.

    ``language.weight(left, symbol)`` is the weight of writing a symbol in the
    state ``left``, which is the symbol before it if ``language.remembers``, else
    BEGIN throughout; ``language.known`` keeps the weights asked for, by left << 21 | symbol.
    A state of the composition is (characters read, machine's state, language's
    state). Those for the next character follow from those for this one, so only
    they and the paths to them are kept. Between pieces the machine stands in
    ``home``, where a text may end.
    """

    def __init__(self, machine: Machine, language):
        self.language = language
        homes = {to for arcs in machine.silent[1:] for _, _, to in arcs}
        at_home = min(homes, default=0)
        if len(homes) > 1 or machine.silent[at_home] or any(len(x) > 1 for x in machine.silent):
            raise ValueError("a state has one arc at most that reads nothing, and these lead to one state that has none")
        if any(x for state, x in enumerate(machine.rest) if state != at_home):
            raise ValueError("only the state between pieces may copy what it reads")
        #: Per state: character -> the next state's (None if it has no arcs), and what is written there on the way home, with its weight.
        nodes: list[dict] = [{} for _ in machine.arcs]
        for state, arcs in enumerate(machine.arcs):
            for read, (out, weight, to) in arcs.items():
                if out != NOTHING or weight:
                    raise ValueError("an arc that reads a symbol may not write")
                symbol, weight, _ = machine.silent[to][0] if machine.silent[to] else (NOTHING, 0.0, to)
                nodes[state][chr(read - LONE)] = (nodes[to] if machine.arcs[to] else None, symbol, weight)
        self.home = nodes[at_home]
        self.lone = machine.rest[at_home][1] if machine.rest[at_home] else INFINITY
        begin = (BEGIN, 0.0, None, NOTHING)
        self.inside = [(self.home, begin)]
        self.start = list(self.inside) if at_home == 0 else []
        for _, _, to in machine.silent[0]:  # the prefix has been written: one of the pieces begins with it, or it is one
            self.start.append((nodes[to], begin))
            for symbol, weight, _ in machine.silent[to]:
                distance = weight + language.weight(BEGIN, symbol)
                self.start.append((self.home, (symbol << 21 if language.remembers else BEGIN, distance, begin, symbol)))

    def path(self, text: str, whole: bool = True) -> list[int]:
        """Symbols on the shortest path for a text that is not empty; ``whole`` starts before the text, else at home, as between two parts.

        Of paths alike in weight the one whose last symbol starts first is taken, as in the library."""
        home, lone, language = self.home, self.lone, self.language
        known, remembers = language.known, language.remembers
        live = self.start if whole else self.inside
        # an origin: language's state << 21, distance, the origin before it, the symbol written from there to here
        for c in text:
            moved, best = [], {}
            for node, origin in live:
                hit = node.get(c)
                if hit is not None:
                    node, symbol, weight = hit
                    if node is not None:
                        moved.append((node, origin))
                    if symbol == NOTHING:
                        continue
                elif node is home:
                    symbol, weight = LONE + ord(c), lone
                else:
                    continue
                left = origin[0]
                more = known.get(left | symbol)
                if more is None:
                    more = language.weight(left >> 21, symbol)
                if more != INFINITY:
                    distance = origin[1] + weight + more
                    after = symbol << 21 if remembers else BEGIN
                    if after not in best or distance < best[after][1]:
                        best[after] = (after, distance, origin, symbol)
            for x in best.values():
                moved.append((home, x))
            live = moved
        ends = [x for node, x in live if node is home]
        at = min(ends, key=lambda x: x[1]) if ends else self.inside[0][1]
        made = []
        while at[2] is not None:
            made.append(at[3])
            at = at[2]
        made.reverse()
        return made
