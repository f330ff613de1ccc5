"""Small deterministic transducers over token classes, and their composition.

A symbol is a class letter and a set of marks, written after it: ``I`` an insult,
``T`` a threat, ``Y`` a target, ``N`` a negation, ``R`` a reporting word, ``Q`` a
quotation mark, ``O`` any other token.  A transducer reads symbols, looks at their
letter, and passes them on with marks added.  ``compose(a, b)`` feeds what ``a``
writes to ``b``; the product is built once and then runs as one table.
"""

from __future__ import annotations

from dataclasses import dataclass, field

LETTERS = "ITYNRQO"
HOSTILE = "IT"


@dataclass
class Transducer:
    """``step[state][letter] = (next state, marks added)``; state 0 is the start and every state may end."""

    step: list[dict[str, tuple[int, str]]] = field(default_factory=list)

    def run(self, letters: str) -> list[str]:
        """Marks of each symbol read."""
        state, out = 0, []
        for x in letters:
            state, marks = self.step[state][x]
            out.append(marks)
        return out


def window(opens: str, mark: str, length: int) -> Transducer:
    """Hostile symbols up to ``length`` symbols after one of ``opens`` get ``mark``."""
    step = []
    for left in range(length + 1):
        step.append({x: (length, "") if x in opens else (max(0, left - 1), mark if left and x in HOSTILE else "") for x in LETTERS})
    return Transducer(step)


def reported_speech(length: int) -> Transducer:
    """Between quotation marks, or up to ``length`` symbols after a reporting word, hostile symbols get ``r``."""
    quoted = length + 1
    step = []
    for left in range(length + 1):
        row = {x: (max(0, left - 1), "r" if left and x in HOSTILE else "") for x in LETTERS}
        row["R"], row["Q"] = (length, ""), (quoted, "")
        step.append(row)
    inside = {x: (quoted, "r" if x in HOSTILE else "") for x in LETTERS}
    inside["Q"] = (0, "")
    return Transducer([*step, inside])


def compose(a: Transducer, b: Transducer) -> Transducer:
    """The transducer that runs ``a`` and gives its output to ``b``."""
    index = {(0, 0): 0}
    todo, step = [(0, 0)], []
    for pair in todo:
        row = {}
        for x in LETTERS:
            (sa, ma), (sb, mb) = a.step[pair[0]][x], b.step[pair[1]][x]
            if (sa, sb) not in index:
                index[sa, sb] = len(index)
                todo.append((sa, sb))
            row[x] = (index[sa, sb], ma + mb)
        step.append(row)
    return Transducer(step)
