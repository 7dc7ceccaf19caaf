"""Column functions over the prompts of benchmark problems: target module, embedded code, interface."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltstone.functions import rtl

# How prompts name modules, embed code and list ports.
_ID = r"[A-Za-z_][A-Za-z0-9_$]*"
NAMED = rf"(?i)\bmodule\s+named\s+({_ID})\b"
INTERFACE = r"(?i)\btop-level\s+module\s+with\s+the\s+following\s+interface\b"
EMBEDDED = rf"(?ims)^[ \t]*(?:synthesis\s+verilog_input_version\s+verilog_2001\s*\r?\n)?[ \t]*module\s+({_ID})\b.*?^[ \t]*endmodule\b"
BUGGY = r"(?i)\bUnfortunately,\s+this\s+module\s+has\s+a\s+bug\b"
BULLET = rf"(?im)^\s*-\s*(input|output|inout)\s+({_ID})\b(.*)$"
PORT = r"(?im)^\s*(?:input|output|inout)\b[^\n;)]*[,)]?\s*$"
PREFIX = "VerilogEval prompt/specification for reviewer context:\n"


def _text(prompt: Column) -> Column:
    return F.coalesce(prompt, F.lit(""))


def embedded_module(prompt: Column) -> Column:
    """The first module in the prompt, with one line end after it; null if there is none."""
    found = F.regexp_extract(_text(prompt), EMBEDDED, 0)
    return F.when(found != "", F.concat(F.regexp_replace(found, r"^[\r\n]+|[\r\n]+$", ""), F.lit("\n")))


def embedded_candidate(prompt: Column) -> Column:
    """EXT-15: that module, if it is named TopModule and the prompt says that it has a bug."""
    return F.when((F.regexp_extract(_text(prompt), EMBEDDED, 1) == "TopModule") & _text(prompt).rlike(BUGGY), embedded_module(prompt))


def embedded_context(prompt: Column) -> Column:
    """EXT-16: that module, if it is no candidate."""
    return F.when(embedded_candidate(prompt).isNull(), embedded_module(prompt))


def target_module(prompt: Column) -> Column:
    """EXT-14: the module the prompt names, else the embedded one, else TopModule where it announces an interface."""
    named, inside = (F.regexp_extract(_text(prompt), p, 1) for p in (NAMED, EMBEDDED))
    return F.when(named != "", named).when(inside != "", inside).when(_text(prompt).rlike(INTERFACE), "TopModule")


def interface_ports(prompt: Column) -> Column:
    """EXT-13: the ports the prompt lists, else those of the embedded module, as "direction name ..."."""
    lines = F.regexp_extract_all(_text(prompt), F.lit(BULLET), 0)
    part = lambda x, k: F.regexp_extract(x, BULLET, k)
    listed = F.transform(lines, lambda x: F.concat(F.lower(part(x, 1)), F.lit(" "), part(x, 2), F.regexp_replace(part(x, 3), r"\s+$", "")))
    found = F.regexp_extract_all(F.coalesce(embedded_module(prompt), F.lit("")), F.lit(PORT), 0)
    body = lambda x: F.trim(F.regexp_replace(F.regexp_replace(F.regexp_extract(x, r"(?is)^\s*(?:input|output|inout)\b(.*)$", 1), r"[,)]?\s*$", ""), r"\s+", " "))
    inside = F.transform(found, lambda x: F.struct(F.lower(F.regexp_extract(x, "(?i)(input|output|inout)", 1)).alias("d"), F.regexp_replace(body(x), ",$", "").alias("b")))
    inside = F.transform(F.filter(inside, lambda x: F.trim(x["b"]) != ""), lambda x: F.concat(x["d"], F.lit(" "), F.trim(x["b"])))
    return F.when(F.size(listed) > 0, listed).otherwise(inside)


def port_name(port: Column) -> Column:
    """HLP-7: the last name in a port's text, ranges and type words left out."""
    bare = F.regexp_replace(F.regexp_replace(port, r"\[[^\]]+\]", " "), r"(?i)\b(?:input|output|inout|wire|reg|logic|signed|unsigned|integer|bit)\b", " ")
    return F.try_element_at(F.regexp_extract_all(bare, F.lit(_ID), 0), F.lit(-1))


def prompt_directions(prompt: Column) -> Column:
    """HLP-8: map from port name to direction; the last mention decides."""
    each = F.filter(F.transform(interface_ports(prompt), lambda p: F.struct(port_name(p).alias("key"), F.substring_index(p, " ", 1).alias("value"))), lambda x: x["key"].isNotNull())
    last = F.filter(each, lambda x, i: ~F.exists(F.slice(each, i + 2, F.greatest(F.size(each), F.lit(1))), lambda y: y["key"] == x["key"]))
    return F.map_from_entries(last)


def direction_mismatches(prompt: Column, code: Column) -> Column:
    """NRM-4: (port, prompt_direction, rtl_direction) where the two disagree, by port."""
    said, real = prompt_directions(prompt), rtl.port_directions(code)
    both = F.transform(F.array_sort(F.map_keys(said)), lambda p: F.struct(p.alias("port"), F.element_at(said, p).alias("prompt_direction"), F.try_element_at(real, p).alias("rtl_direction")))
    return F.filter(both, lambda x: x["rtl_direction"].isNotNull() & (x["rtl_direction"] != x["prompt_direction"]))


def raw_prompt(metadata_prompt: Column, log: Column) -> Column:
    """HLP-4: the prompt kept apart, else the log without its heading."""
    return F.coalesce(metadata_prompt, F.when(log.startswith(PREFIX), F.substring(log, len(PREFIX) + 1, 1 << 30)).otherwise(log))
