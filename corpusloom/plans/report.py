"""A report on a published dataset as markdown: sections of tables over a few aggregated rows, and its change detection."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

#: What the answer parser's rules say, in the order in which they are tried.
RULES = {
    "input_too_long": "the engine refused the prompt, with numbers that bear it out", "truncated": "generation stopped at its length limit", "unclosed_think": "no end of the reasoning in the output",
    "empty": "white space only after the reasoning", "ambiguous": "yes and no are both among the words", "non_english_token": "only a yes or no of another language", "no_label": "none of the rules found a label",
}


@dataclass(frozen=True)
class Section:
    """A title, sentences, and a table: columns by name, numbers right-aligned."""

    title: str
    lines: Sequence[str] = ()
    columns: Sequence[str] = ()
    rows: Iterable[Sequence[object]] = ()

    def text(self) -> str:
        return "\n\n".join([f"## {self.title}", *self.lines, *([grid(self.columns, self.rows)] if self.columns else [])])


@dataclass(frozen=True)
class Facts:
    """What a report is made from; all of it is aggregated."""

    name: str
    files: int
    files_done: int
    files_begun: int
    decisions: Mapping[str, int]
    failures: Mapping[str, int]
    outputs: int
    keys: Sequence[str]
    fingerprint: str
    licence: str
    map: Mapping[str, float] | None = None
    gates: Mapping[str, Mapping[str, float]] = field(default_factory=dict)


def cell(value: object) -> str:
    """Whole numbers by thousands, other numbers to four digits, text as it is."""
    if isinstance(value, bool) or not isinstance(value, int | float):
        return str(value)
    return f"{value:,}" if isinstance(value, int) else f"{value:.4f}"


def grid(columns: Sequence[str], rows: Iterable[Sequence[object]]) -> str:
    """A markdown table; a column is right-aligned if its first value is a number."""
    rows = [list(r) for r in rows]
    number = [bool(rows) and isinstance(v, int | float) for v in (rows[0] if rows else columns)]
    lines = [list(columns), ["--:" if n else ":--" for n in number], *([cell(v) for v in r] for r in rows)]
    return "\n".join("| " + " | ".join(line) + " |" for line in lines)


def per_mille(part: int, whole: int) -> float:
    return round(1000 * part / whole, 2) if whole else 0.0


def counted(counts: Mapping[str, int]) -> list[tuple[str, int, float]]:
    """name, rows, rows in a thousand; the largest first, then by name; empty ones are left out."""
    whole = sum(counts.values())
    return [(n, c, per_mille(c, whole)) for n, c in sorted(counts.items(), key=lambda x: (-x[1], x[0])) if c]


def sections(f: Facts) -> list[Section]:
    """Only those with something to say."""
    out = [Section("Progress", columns=("files", "done", "begun", "rows", "texts with outputs"), rows=[(f.files, f.files_done, f.files_begun, sum(f.decisions.values()), f.outputs)])]
    out.append(Section("Decisions", columns=("decision", "rows", "‰"), rows=counted(f.decisions)))
    if any(f.failures.values()):
        out.append(Section("Unreadable outputs", ["The parser tries its rules in a fixed order; the first that fits gives the reason."], ("reason", "rows", "‰", "rule"), [(*r, RULES.get(r[0], "")) for r in counted(f.failures)]))
    if f.map:
        out.append(Section("On the map", columns=tuple(f.map), rows=[tuple(f.map.values())]))
    if f.gates:
        names = sorted({n for g in f.gates.values() for n in g})
        out.append(Section("Against the reference model", columns=("hardware", *names), rows=[(h, *(float(g.get(n, 0)) for n in names)) for h, g in sorted(f.gates.items())]))
    out.append(Section("How to join", [f"Labels join the input by {', '.join(f.keys)}, and outputs by generation_id. Configuration {f.fingerprint}. Licence: {f.licence}."]))
    return out


def render(f: Facts) -> str:
    """The whole report, with its state on top for programs to read."""
    state = "complete" if f.files_done == f.files else "growing"
    return "\n\n".join([f"---\ntitle: {f.name}\nstate: {state}\n---", *(s.text() for s in sections(f))]) + "\n"


def digest(files: Mapping[str, bytes]) -> str:
    """Changes if a name or the content of a report's file does; only then is it written again."""
    return hashlib.sha256(b"\0".join(n.encode() + b"\0" + d for n, d in sorted(files.items()))).hexdigest()
