"""The rule language: groups of condition and rule lines, and addressed edits of them.

A text looks like::

    规则组1
    C: 环境|室温
    R: 电流|增大 + 电压|不变 —[导致]→ 熔深|增大

A line ``C`` gives the conditions of the rules after it in its group; ``R`` has antecedents, an arrow that may name a
relation, and consequents. States are written ``object|state`` or ``object=state``. An arrow may also be written
``=导致=>``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.functions.text import hashed_id

# The heads of the language, its arrows, what stands for nothing, and words that are degrees and no objects.
_HEAD = re.compile(r"(?:规则组|rule\s*group)\s*(?P<name>[\w-]+)?\s*[:：]?", re.IGNORECASE)
_INLINE_HEAD = re.compile(r"^\s*((?:规则组|rule\s*group)\s*[\w-]+)\s*[，,]\s*", re.IGNORECASE | re.MULTILINE)
_INLINE_ENTRY = re.compile(r"[，,]\s*([CR])\s*[:：]", re.IGNORECASE)
_ENTRY = re.compile(r"\s*(?P<kind>[CR])\s*[:：]\s*(?P<body>.*)", re.IGNORECASE)
_EVIDENCE = re.compile(r"\s*(?:依据|证据)\s*[:：]")
_ARROW = re.compile(r"\s*(?:(?:[—－-]\s*(?:\[\s*(?P<formula>.*?)\s*\]\s*|(?P<word>[^\s→]+?)\s*))?(?:→|->|⇒|⟶)|=(?P<equals>[^=>|]*)=>)\s*")
_NO_RULE = re.compile(r"(?:^|\s)(?:no[_ -]?rule|无规则|没有(?:可抽取)?规则)(?:\s|$)", re.IGNORECASE)
_NEXT_STATE = re.compile(r"\s+\+\s+(?=[^+\n]*[|=])")
_NUMERIC = re.compile(r"(?:约|近似|≈)?\s*[<>≤≥]?\s*[+-]?\d")
_DEGREES = frozenset("大 小 高 低 较大 较小 较高 较低 很大 很小 很高 很低".split())
_NOTHING = frozenset(("", "无", "none", "None", "-"))
_PORES = re.compile(r"(无|少量|大量)\s*气孔")
_COMPARED = (("不低于", "≥"), ("不少于", "≥"), ("不超过", "≤"), ("小于", "<"), ("低于", "<"), ("大于", ">"), ("高于", ">"), ("约", "≈"))
_UNIT_GAP = re.compile(r"(?<=\d)\s*(?=(?:mm|cm|m|MPa|kPa|A|V|°C|℃|°|%|L\s*/\s*min)\b)")
_MENTIONED, _STATED, _CONTEXT = "提及", "陈述", ("原文上下文", "存在")

_SIDE = "array<struct<state_id:string,object:string,raw_state:string,normalized_state:string>>"
RULES = f"rule_id string, `group` string, idx int, conditions {_SIDE}, antecedents {_SIDE}, relation string, consequents {_SIDE}, transitions array<struct<object:string,from_state_id:string,to_state_id:string>>, expression string, error string"


class RuleError(ValueError):
    """A text that is not in the language."""


def display(state: str) -> str:
    """A state as it is shown: a leading word of comparison as a sign, one dash for ranges, one blank before units."""
    text = re.sub("[～~]", "–", state.strip())
    for word, sign in _COMPARED:
        if text.startswith(word):
            text = f"{sign} {text.removeprefix(word).strip()}"
            break
    return " ".join(_UNIT_GAP.sub(" ", text).split())


@dataclass(frozen=True)
class State:
    """An object with one of its states."""

    object: str
    raw_state: str

    def row(self) -> dict[str, str]:
        shown = display(self.raw_state)
        return {"state_id": hashed_id("state", self.object, self.raw_state, shown), "object": self.object, "raw_state": self.raw_state, "normalized_state": shown}


def _state(piece: str) -> State:
    mark = "|" if "|" in piece else "=" if "=" in piece else None
    if mark is None:
        bare = piece.strip(" \t。；;")
        if m := _PORES.fullmatch(bare):
            return State("气孔", m.group(1))
        if bare in _DEGREES or _NUMERIC.match(bare):
            raise RuleError(f"a value without an object: {piece}")
        found = State(bare, _MENTIONED)
    else:
        found = State(*(half.strip(" \t。；;") for half in piece.split(mark, 1)))
    if not (found.object and found.raw_state):
        raise RuleError(f"an object or a state is empty: {piece}")
    return found


def states(side: str) -> list[State]:
    """The states of one side; a plus divides them only before another object with its state."""
    text = re.sub(r"\s*\n\s*", " ", side).strip()
    if text in _NOTHING:
        return []
    found = [_state(p.strip()) for p in _NEXT_STATE.split(text) if p.strip()]
    if not found:
        raise RuleError("a side without states")
    return found


def entries(text: str) -> Iterator[tuple[str, str, str]]:
    """(group, C or R, body) in order. A group without a name has the number of the groups with rules before it, plus one.

    Fences, list marks, emphasis, rulers and lines of evidence are no part of the language; a group on one line is taken
    apart; other lines go on with the entry before them. A condition with an arrow is a rule.
    """
    text = _INLINE_ENTRY.sub(r"\n\1: ", _INLINE_HEAD.sub(r"\1\n", re.sub(r"```(?:dsl|text)?", "", text)))
    group, with_rules, held = "group_1", 0, None
    rules_here = False

    def done(entry: tuple[str, list[str]] | None) -> list[tuple[str, str, str]]:
        if entry is None:
            return []
        body = " ".join(entry[1]).strip()
        return [(group, "R" if entry[0] == "C" and _ARROW.search(body) else entry[0], body)]

    for raw in text.splitlines():
        line = re.sub(r"\*|__", "", re.sub(r"^[*+-]\s*", "", raw.strip()))
        if _EVIDENCE.match(line) or re.fullmatch(r"\s*-*\s*", line):
            continue
        head, entry = _HEAD.fullmatch(line.strip()), _ENTRY.fullmatch(line)
        if head or entry:
            for x in done(held):
                rules_here |= x[1] == "R"
                yield x
            held = None
        if head:
            with_rules, rules_here = with_rules + rules_here, False
            group = f"group_{head['name'] or with_rules + 1}"
        elif entry:
            held = (entry["kind"].upper(), [entry["body"]])
        elif held:
            held[1].append(line.strip())
    yield from done(held)


def _rule(package: str, group: str, index: int, body: str, conditions: list[State]) -> dict:
    arrow = _ARROW.search(body)
    if arrow:
        before, after = states(body[: arrow.start()]), states(body[arrow.end() :])
        relation = next((r.strip() for r in (arrow["formula"], arrow["word"], arrow["equals"]) if r and r.strip()), None)
        conditions = [c for c in conditions if c not in before]
    else:
        # a rule without an arrow states a fact, under its conditions if it has any
        after, relation = states(body), _STATED
        conditions = [c for c in conditions if c not in after]
        before = conditions or [State(*_CONTEXT)]
    rows = {k: [s.row() for s in v] for k, v in (("conditions", conditions), ("antecedents", before), ("consequents", after))}
    moves = [{"object": a["object"], "from_state_id": a["state_id"], "to_state_id": b["state_id"]} for a in rows["antecedents"] for b in rows["consequents"] if arrow and a["object"] == b["object"] and a["raw_state"] != b["raw_state"]]
    return {"rule_id": hashed_id("rule", package, group, str(index), body), "group": group, "idx": index, **rows, "relation": relation, "transitions": moves, "expression": body, "error": None}


def parse(text: str | None, package: str = "") -> list[dict]:
    """The rules of a text, numbered through all its groups, each under the conditions that stand before it in its group.

    A text that says that it has no rule has none; a null or empty text, one without rules, and malformed states are
    errors (``RuleError``).
    """
    if not (text or "").strip():
        raise RuleError("the text is empty")
    if _NO_RULE.search(text) and not re.search(r"^\s*R\s*[:：]", text, re.MULTILINE | re.IGNORECASE):
        return []
    out: list[dict] = []
    at, conditions, pending = None, [], []
    for group, kind, body in entries(text):
        if group != at:
            at, conditions = group, []
        if kind == "C":
            conditions = states(body)
        else:
            pending.append((group, body, conditions))
    for group, body, conditions in pending:
        out.append(_rule(package, group, len(out) + 1, body, conditions))
    if not out:
        raise RuleError("no rule found")
    return out


def parse_rules(texts: DataFrame, text: str, keys: list[str], package: str | None = None) -> DataFrame:
    """One row per rule of each text with the given key columns (Arrow batches); a malformed text is one row with ``error``."""
    schema = ", ".join(f"`{k}` {texts.schema[k].dataType.simpleString()}" for k in keys) + ", " + RULES
    names = [c.strip().strip("`").split("` ")[0].split(" ")[0] for c in ("rule_id", "group", "idx", "conditions", "antecedents", "relation", "consequents", "transitions", "expression", "error")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for row in pdf.to_dict("records"):
                try:
                    found = parse(row[text], row[package] if package else "")
                except RuleError as e:
                    found = [{"error": str(e)}]
                rows += [[*[row[k] for k in keys], *[r.get(n) for n in names]] for r in found]
            yield pd.DataFrame(rows, columns=[*keys, *names]).astype({"idx": "Int32"})

    return texts.select(*dict.fromkeys([*keys, text, *([package] if package else [])])).mapInPandas(run, schema)


# --- edits --------------------------------------------------------------------------------------------------------------

_EMPTY = "无规则"
_NO_CONDITION = "C: 无"
_DRAFT_HEAD = re.compile(r"规则组\s*([\w-]+)\s*[:：]?")


@dataclass
class Group:
    """A group of a draft that can be edited: its head, at most one line of conditions and its rule lines."""

    name: str
    head: str
    condition: str | None = None
    rules: list[str] = field(default_factory=list)

    def text(self) -> str:
        return "\n".join([self.head, self.condition or _NO_CONDITION, *self.rules])


def draft(text: str) -> dict[str, Group]:
    """The groups of a draft by name. Anything but heads, one C line before the R lines, and R lines is an error."""
    out: dict[str, Group] = {}
    here: Group | None = None
    for line in filter(None, map(str.strip, text.strip().splitlines())) if text.strip() != _EMPTY else ():
        if head := _DRAFT_HEAD.fullmatch(line):
            here = Group(head.group(1), line)
            if here.name in out:
                raise RuleError(f"group {here.name} stands twice")
            out[here.name] = here
            continue
        kind = m["kind"].upper() if (m := _ENTRY.fullmatch(line)) else None
        if here is None or kind is None:
            raise RuleError(f"a draft has no such line: {line}")
        if kind == "R":
            here.rules.append(line)
        elif here.condition or here.rules:
            raise RuleError(f"group {here.name} has a C line too many or too late")
        else:
            here.condition = line
    if text.strip() != _EMPTY and (not out or any(not g.rules for g in out.values())):
        raise RuleError("every group needs a rule")
    return out


def _written(groups: list[Group]) -> str:
    return "\n".join(g.text() for g in groups) or _EMPTY


def addressed(text: str) -> str:
    """A draft with the address ``[group/number]`` before each rule."""
    lines = []
    for g in draft(text).values():
        lines += [g.head, g.condition or _NO_CONDITION, *(f"[{g.name}/{n}] {r}" for n, r in enumerate(g.rules, 1))]
    return "\n".join(lines) or _EMPTY


class _Lines:
    """The lines of a patch, read from the first to the last."""

    def __init__(self, text: str) -> None:
        self.left = [x.rstrip() for x in text.splitlines() if x.strip()][::-1]

    def next(self) -> str:
        return self.left.pop().strip()

    def entry(self, kind: str) -> str:
        m = _ENTRY.fullmatch(self.left[-1]) if self.left else None
        if not m or m["kind"].upper() != kind or self.left[-1][:1].isspace():
            raise RuleError(f"a line {kind}: is missing")
        return self.next()

    def until(self, end: str) -> str:
        body: list[str] = []
        while self.left:
            if (line := self.left.pop()).strip() == end:
                return "\n".join(body).strip()
            body.append(line)
        raise RuleError(f"{end} is missing")


@dataclass
class _Edits:
    """What a patch does to one group of the draft."""

    condition: str | None = None
    rules: dict[int, str | None] = field(default_factory=dict)
    added: list[str] = field(default_factory=list)
    whole: Group | None = None
    gone: bool = False

    def apply(self, group: Group) -> list[Group]:
        if self.whole or self.gone:
            if self.condition or self.rules or self.added:
                raise RuleError(f"group {group.name} is edited as a whole and in part")
            return [] if self.gone else [self.whole]
        kept = [self.rules.get(n, r) for n, r in enumerate(group.rules, 1)]
        rules = [r for r in kept if r is not None] + self.added
        return [Group(group.name, group.head, self.condition or group.condition, rules)] if rules else []


def apply_patch(text: str, patch: str) -> str:
    """The draft after the edits of a patch; all addresses are those of the draft as it was.

    ``NO_CHANGES`` or ``REPLACE_ALL`` (up to ``END_ALL``) alone, or any of ``SET_C g``, ``DELETE_C g``, ``REPLACE_R g/n``,
    ``DELETE_R g/n``, ``ADD_R g``, ``REPLACE_GROUP g``, ``DELETE_GROUP g`` and ``ADD_GROUP``, with a C: or R: line or a group (up
    to ``END_GROUP``) after those that need one. A group that loses all rules goes; edits that change nothing are none.
    Unknown addresses and commands, two edits of one rule, and whole edits of a group besides others are errors.
    """
    lines = _Lines(patch)
    if not lines.left:
        raise RuleError("the patch is empty")
    if patch.strip() == "NO_CHANGES":
        return _written(list(draft(text).values()))
    if lines.left[-1].strip() == "REPLACE_ALL":
        lines.next()
        whole = lines.until("END_ALL")
        if lines.left:
            raise RuleError("REPLACE_ALL stands with other edits")
        return _written(list(draft(whole).values()))
    groups = draft(text)
    edits: dict[str, _Edits] = {name: _Edits() for name in groups}
    new: dict[str, Group] = {}

    def one_group(body: str) -> Group:
        found = list(draft(body).values())
        if len(found) != 1:
            raise RuleError("one group is needed")
        return found[0]

    while lines.left:
        command, _, target = lines.next().partition(" ")
        target = target.strip()
        if command == "ADD_GROUP" and not target:
            group = one_group(lines.until("END_GROUP"))
            if group.name in new or (group.name in groups and not edits[group.name].gone):
                raise RuleError(f"group {group.name} exists")
            new[group.name] = group
            continue
        name, slash, number = target.partition("/")
        if command not in ("SET_C", "DELETE_C", "REPLACE_R", "DELETE_R", "ADD_R", "REPLACE_GROUP", "DELETE_GROUP"):
            raise RuleError(f"no such edit: {command}")
        of_rule = command in ("REPLACE_R", "DELETE_R")
        known = name in groups and bool(slash) == of_rule
        if not known or (of_rule and not (re.fullmatch(r"[1-9]\d*", number) and int(number) <= len(groups[name].rules))):
            raise RuleError(f"no such address: {target}")
        group, edit = groups[name], edits[name]
        if command in ("SET_C", "DELETE_C"):
            condition = lines.entry("C") if command == "SET_C" else _NO_CONDITION
            if condition != (group.condition or _NO_CONDITION):
                edit.condition = condition
        elif of_rule:
            n = int(number)
            if n in edit.rules:
                raise RuleError(f"two edits of {target}")
            rule = lines.entry("R") if command == "REPLACE_R" else None
            if rule != group.rules[n - 1]:
                edit.rules[n] = rule
        elif command == "ADD_R":
            edit.added.append(lines.entry("R"))
        elif command == "DELETE_GROUP":
            edit.gone = True
        else:
            whole = one_group(lines.until("END_GROUP"))
            if whole.name != name:
                raise RuleError(f"another group than {name}")
            if whole.text() != group.text():
                edit.whole = whole
    return _written([g for name, group in groups.items() for g in edits[name].apply(group)] + list(new.values()))


def patched(drafts: pd.Series, patches: pd.Series) -> pd.DataFrame:
    """(text, error) of each draft with its patch; nulls count as empty."""
    rows = []
    for d, p in zip(drafts, patches, strict=True):
        try:
            rows.append((apply_patch(d or "", p or ""), None))
        except RuleError as e:
            rows.append((None, str(e)))
    return pd.DataFrame(rows, columns=["text", "error"])


def patch_column(text: Column, patch: Column) -> Column:
    """A struct (text, error) of the patched draft (Arrow batches)."""

    @F.pandas_udf("text string, error string")
    def run(drafts: pd.Series, patches: pd.Series) -> pd.DataFrame:
        return patched(drafts, patches)

    return run(text, patch)
