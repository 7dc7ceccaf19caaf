"""Seeded single edits of hardware description texts: each changes the first place that fits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions import rtl
from siltstone.functions.once import let

# The shapes of text that the edits look for.
_ID = r"[A-Za-z_][A-Za-z0-9_$]*"
_PLACE = rf"{_ID}(?:\[[^\]]+\])?"
_SELECT = rf"(?:sel|select|mux|{_ID}(?:sel|select|mux)[A-Za-z0-9_$]*)"
TERNARY = rf"(?i)\b({_SELECT})\s*\?\s*([^:;\n]+)\s*:\s*([^;\n]+)"
BRANCH = rf"(?i)if\s*\(\s*({_SELECT})\s*\)"
COMBINATIONAL, CLOCKED = r"(?i)\balways_comb\b|\balways\s*@\s*\*", r"(?i)\balways_ff\b|\balways\s*@\s*\([^)]*posedge"
ELSE = rf"([ \t]*)else\s+({_PLACE})\s*=\s*[^;]+;"
LIMIT = rf"(?i)({_ID}(?:count|counter|cnt|timer)[A-Za-z0-9_$]*)\s*(<=|>=|<|>)\s*([^)\n;]+)"
SHIFT = rf"({_PLACE})\s*(<=|=)\s*([^;]*?)(<<|>>)([^;]*);"
NONBLOCKING = rf"({_PLACE})\s*<=\s*([^;]+);"
_LITERAL = r"\d+'[bBdDhHoO][0-9a-fA-F_xXzZ]+|\d+"
_RESET_HEAD = rf"if\s*\(\s*(?:!|~)?\s*{_ID}\s*\)\s*(?:begin\s*)?"


def first_edit(text: Column, pattern: str | Column, replacement: Column) -> Column:
    """text with the first match of ``pattern`` replaced; null where nothing matches."""
    p = F.lit(pattern) if isinstance(pattern, str) else pattern
    at, found = F.regexp_instr(text, p), F.regexp_substr(text, p)
    return F.when(at > 0, F.concat(F.substring(text, F.lit(1), at - 1), replacement, F.substring(text, at + F.length(found), F.length(text))))


def toggled(literal: Column) -> Column:
    """A number with 0 and 1 exchanged (any other becomes 0), width and base kept; null with x or z digits."""
    sized = r"(?i)^(\d+)'([bdho])([0-9a-f_xz]+)$"
    width, base = F.regexp_extract(literal, sized, 1).try_cast("int"), F.lower(F.regexp_extract(literal, sized, 2))
    digits = F.replace(F.lower(F.regexp_extract(literal, sized, 3)), F.lit("_"), F.lit(""))
    new = F.when(F.when(base != "", digits).otherwise(literal).rlike("^0+$"), "1").otherwise("0")
    per = F.when(base == "b", 1).when(base == "o", 3).when(base == "h", 4)
    filled = F.when(per.isNull(), new).otherwise(F.lpad(new, F.greatest(F.ceil(width / per), F.lit(1)).cast("int"), F.lit("0")))
    return F.when(base == "", new).when(~digits.rlike("[xz]"), F.concat(width.cast("string"), F.lit("'"), base, filled))


def _base(place: Column) -> Column:
    return F.substring_index(place, "[", 1)


def _exact(name: Column) -> Column:
    return F.concat(F.lit(r"\Q"), name, F.lit(r"\E"))


def _first(found: Column) -> Column:
    return F.try_element_at(F.filter(found, lambda x: x.isNotNull()), F.lit(1))


# How each edit is summed up; {0} is its signal, {1} and {2} the old and the new text.
SUMMARIES = {
    "reset": "Changed reset polarity check from '{1}' to '{2}'.",
    "select": "Inverted mux select polarity for signal {0}.",
    "branch": "Inverted branch select polarity for signal {0}.",
    "else": "Removed an else-branch assignment for combinational signal {0}.",
    "limit": "Changed counter limit comparison for {0} from '{1}' to '{2}'.",
    "shift": "Flipped shift direction for assignment to {0} from '{1}' to '{2}'.",
    "blocking": "Changed a clocked nonblocking assignment on {0} to a blocking assignment.",
    "width": "Truncated the RHS driving vector output {0} to only bit 0.",
    "state": "Changed the reset-state assignment for {0} from '{1}' to '{2}'.",
}


def _summary(kind: str, *values: Column) -> Column:
    out = F.lit(SUMMARIES[kind])
    for k, v in enumerate(values):
        out = F.replace(out, F.lit(f"{{{k}}}"), F.coalesce(v, F.lit("")))
    return out


def _edit(text: Column | None, signals: Column, confidence: str, said: Column) -> Column:
    return let(text, lambda t: F.when(t.isNotNull(), F.struct(t.alias("mutated"), signals.alias("signals"), F.lit(confidence).alias("confidence"), said.alias("summary"))))


def candidates(text: Column) -> dict[str, Column]:
    """Bug type -> (mutated, signals, confidence, summary), null where the type does not apply."""
    group = lambda pattern, k: F.regexp_extract(text, pattern, k)
    about = rtl.summary(text)

    def reset(name):
        low = F.concat(F.lit(r"if\s*\(\s*[!~]\s*"), _exact(name), F.lit(r"\s*\)"))
        high = F.concat(F.lit(r"if\s*\(\s*"), _exact(name), F.lit(r"\s*\)"))
        plain, negated = F.concat(F.lit("if ("), name, F.lit(")")), F.concat(F.lit("if (!"), name, F.lit(")"))
        new = F.coalesce(first_edit(text, low, plain), first_edit(text, high, negated))
        was = F.regexp_substr(text, low)
        said = F.when(was.isNotNull(), _summary("reset", name, was, plain)).otherwise(_summary("reset", name, F.regexp_substr(text, high), negated))
        return _edit(new, F.array(name), "medium", said)

    def truncated(name):
        drive = F.concat(F.lit(r"(?:assign\s+)?"), _exact(name), F.lit(rf"\s*(?:<=|=)\s*{_ID}\s*;"))
        found = F.regexp_substr(text, drive)
        right = F.regexp_extract(found, rf"({_ID})\s*;$", 1)
        return _edit(first_edit(text, drive, F.concat(F.regexp_replace(found, rf"{_ID}\s*;$", ""), right, F.lit("[0];"))), F.array(name, right), "low", _summary("width", name))

    def restarted(name):
        clears = F.concat(F.lit(rf"(?i){_RESET_HEAD}"), _exact(name), F.lit(rf"(?:\[[^\]]+\])?\s*(?:<=|=)\s*(?:{_LITERAL})\s*;"))
        whole = rf"(?is)^({_RESET_HEAD})({_PLACE})\s*(<=|=)\s*({_LITERAL})\s*;$"

        def reset_to(found):
            part = [F.regexp_extract(found, whole, k) for k in range(5)]
            edited = lambda new: first_edit(text, clears, F.concat(part[1], part[2], F.lit(" "), part[3], F.lit(" "), new, F.lit(";")))
            return let(toggled(part[4]), lambda new: _edit(F.when(new != part[4], edited(new)), F.array(name), "low", _summary("state", name, part[4], new)))

        return let(F.regexp_substr(text, clears), reset_to)

    sel, branch = group(TERNARY, 1), group(BRANCH, 1)
    mux = F.coalesce(
        first_edit(text, TERNARY, F.concat(F.lit("!"), sel, F.lit(" ? "), F.trim(group(TERNARY, 2)), F.lit(" : "), F.trim(group(TERNARY, 3)))),
        first_edit(text, BRANCH, F.concat(F.lit("if (!"), branch, F.lit(")"))),
    )
    indent, dropped = group(ELSE, 1), _base(group(ELSE, 2))
    gap = F.concat(indent, F.lit("else begin\n"), indent, F.lit("    /* incomplete_comb_assignment removed assignment to "), dropped, F.lit(" */\n"), indent, F.lit("end"))
    op = group(LIMIT, 2)
    other = F.when(op.endswith("="), F.substring(op, 1, 1)).otherwise(F.concat(op, F.lit("=")))
    turned = F.when(group(SHIFT, 4) == "<<", ">>").otherwise("<<")
    shift = F.concat(group(SHIFT, 1), F.lit(" "), group(SHIFT, 2), F.lit(" "), group(SHIFT, 3), turned, group(SHIFT, 5), F.lit(";"))
    return {
        "wrong_reset_polarity": _first(F.transform(about["reset_signals"], reset)),
        "wrong_mux_select_polarity": _edit(mux, F.array(F.when(sel != "", sel).otherwise(branch)), "medium", F.when(sel != "", _summary("select", sel)).otherwise(_summary("branch", branch))),
        "incomplete_comb_assignment": _edit(F.when(text.rlike(COMBINATIONAL), first_edit(text, ELSE, gap)), F.array(dropped), "low", _summary("else", dropped)),
        "off_by_one_counter_limit": _edit(first_edit(text, LIMIT, F.concat(group(LIMIT, 1), F.lit(" "), other, F.lit(" "), F.trim(group(LIMIT, 3)))), F.array(group(LIMIT, 1)), "medium", _summary("limit", group(LIMIT, 1), op, other)),
        "shift_direction_flip": _edit(first_edit(text, SHIFT, shift), F.array(_base(group(SHIFT, 1))), "medium", _summary("shift", _base(group(SHIFT, 1)), group(SHIFT, 4), turned)),
        "blocking_nonblocking_swap_in_clocked_block": _edit(
            F.when(text.rlike(CLOCKED), first_edit(text, NONBLOCKING, F.concat(group(NONBLOCKING, 1), F.lit(" = "), F.trim(group(NONBLOCKING, 2)), F.lit(";")))), F.array(_base(group(NONBLOCKING, 1))), "medium", _summary("blocking", _base(group(NONBLOCKING, 1)))
        ),
        "width_truncation_output": _first(F.transform(rtl.vector_outputs(text), truncated)),
        "wrong_fsm_reset_state": _first(F.transform(about["suspected_fsm_signals"], restarted)),
    }


EDIT = "struct<bug_type:string,mutated:string,signals:array<string>,confidence:string,summary:string>"


def edits(text: Column) -> Column:
    """All edits that change a text, in the order of their types: an array of ``EDIT``."""

    def typed(k, c):
        return let(c, lambda e: F.when(e.isNotNull(), F.struct(F.lit(k).alias("bug_type"), *[e[n].alias(n) for n in ("mutated", "signals", "confidence", "summary")])))

    return let(text, lambda t: F.filter(F.array(*[typed(k, c) for k, c in candidates(t).items()]), lambda x: x.isNotNull() & (x["mutated"] != t)))


def chosen(found: Column, key: Column, per_row: int, seed: int) -> Column:
    """The ``per_row`` first of some edits by the hash of seed, key and type."""
    ranked = F.transform(found, lambda x: F.struct(F.sha2(F.concat_ws(":", F.lit(str(seed)), key.cast("string"), x["bug_type"]), 256).alias("rank"), x.alias("edit")))
    return F.transform(F.slice(F.array_sort(ranked), 1, per_row), lambda x: x["edit"])


def mutate(rows: DataFrame, key: str, text: str, per_row: int = 1, seed: int = 42, limit: int | None = None) -> DataFrame:
    """(key, bug_type, mutated, signals, confidence): of the edits that change a text, the ``per_row`` first by the hash of seed, key and type.

    ``limit``: only so many rows in all, by key and hash.
    """
    picked = chosen(edits(F.col(text)), F.col(key), per_row, seed)
    out = rows.select(key, F.posexplode(picked).alias("_n", "m"))
    if limit is not None:
        out = out.orderBy(key, "_n").limit(limit)
    return out.select(key, "m.bug_type", "m.mutated", "m.signals", "m.confidence")
