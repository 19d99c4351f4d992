"""Small weighted finite-state transducers over token classes, and their composition.

A transducer reads one symbol a step and passes one on. Composed, the output of the first is the input of the second.
States are numbered from 0, the start. A clause ends with ``END``, on which every transducer goes back to its start.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import product

WORD, INSULT, THREAT, TARGET, NEGATION, REPORT, END = "word", "insult", "threat", "target", "negation", "report", "end"
CLASSES = (WORD, INSULT, THREAT, TARGET, NEGATION, REPORT, END)
#: How many tokens a negation reaches.
SCOPE = 3

Symbol = tuple[str, frozenset]
Step = Callable[[int, Symbol], tuple[int, Symbol]]


def _marked(symbol: Symbol, mark: str) -> Symbol:
    return symbol[0], symbol[1] | {mark}


def negated(state: int, symbol: Symbol) -> tuple[int, Symbol]:
    """Marks insults and threats within ``SCOPE`` tokens of a negation. The state counts the tokens left."""
    if symbol[0] == END:
        return 0, symbol
    if symbol[0] == NEGATION:
        return SCOPE, symbol
    if state and symbol[0] in (INSULT, THREAT):
        return state - 1, _marked(symbol, "negated")
    return max(state - 1, 0), symbol


def reported(state: int, symbol: Symbol) -> tuple[int, Symbol]:
    """Marks insults and threats after a verb of speech in the same clause."""
    if symbol[0] == END:
        return 0, symbol
    if symbol[0] == REPORT:
        return 1, symbol
    return state, _marked(symbol, "reported") if state and symbol[0] in (INSULT, THREAT) else symbol


def targeted(state: int, symbol: Symbol) -> tuple[int, Symbol]:
    """Marks insults and threats in a clause that names a person before them; a target that follows is marked itself."""
    if symbol[0] == END:
        return 0, symbol
    if symbol[0] == TARGET:
        return 1, _marked(symbol, "follows") if state == 2 else symbol
    if symbol[0] in (INSULT, THREAT):
        return (1, _marked(symbol, "targeted")) if state == 1 else (2, symbol)
    return state, symbol


MACHINES: tuple[tuple[Step, int], ...] = ((negated, SCOPE + 1), (reported, 2), (targeted, 3))


def compose(machines: tuple[tuple[Step, int], ...] = MACHINES) -> tuple[list[dict[str, tuple[int, Symbol]]], list[tuple]]:
    """The product machine: for each joint state, class -> (next state, final symbol); and the joint states' names."""
    names = list(product(*[range(size) for _, size in machines]))
    number = {name: i for i, name in enumerate(names)}
    table = []
    for name in names:
        row = {}
        for token in CLASSES:
            symbol, after = (token, frozenset()), []
            for (step, _), state in zip(machines, name, strict=True):
                state, symbol = step(state, symbol)
                after.append(state)
            row[token] = number[tuple(after)], symbol
        table.append(row)
    return table, names


#: Kinds of matched clauses, in the order in which the first marks apply.
KINDS = ("insult", "targeted insult", "negated insult", "reported insult", "threat", "targeted threat", "excused threat",
         "named after")


def kind_of(symbol: Symbol) -> int | None:
    """Index of the kind of match that a final symbol stands for."""
    token, marks = symbol
    if token == TARGET and "follows" in marks:
        return 7
    if token == INSULT:
        return 2 if "negated" in marks else 3 if "reported" in marks else 1 if "targeted" in marks else 0
    if token == THREAT:
        return 6 if marks & {"negated", "reported"} else 5 if "targeted" in marks else 4
    return None
