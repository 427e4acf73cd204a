"""Residue sequences as array columns: tokens, cleavage, labels, modifications. All in Catalyst."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The contexts in which each enzyme cuts, as (cut, residues before; residues after), each side
#: comma-separated from the far end to the near end before the cut, and outwards after it. Later rules win.
ENZYMES: dict[str, list[tuple[bool, str]]] = {
    "trypsin": [(True, "KR;"), (False, "KR;P"), (True, "W,K;P"), (True, "M,R;P"), (False, "CD,K;D"), (False, "C,K;HY"), (False, "C,R;K"), (False, "R,R;HR")],
    "lysc": [(True, "K;")],
    "lysn": [(True, ";K")],
    "argc": [(True, "R;")],
    "aspn": [(True, ";D")],
    "gluc_ph4": [(True, "E;"), (False, "E;PE")],
    "gluc_ph8": [(True, "DE;"), (False, "DE;PE")],
    "cnbr": [(True, "M;")],
    "idosobenzoic": [(True, "W;")],
    "ntcb": [(True, ";C")],
    "endopro": [(True, "AP;")],
    "lysarg": [(True, ";K"), (True, ";R")],
}


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value worked out once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def without_comments(text: Column) -> Column:
    """Text outside of parentheses of any depth; unchanged if they have no partner, so that it is no legal sequence.

    Marks are split off first, then one pass over the parts keeps count of the depth.
    """
    parts = F.split(text, r"(?<=[()])|(?=[()])")
    state = lambda depth, out: F.struct(depth.alias("depth"), out.alias("out"))
    step = lambda a, x: F.when(x == "(", state(a["depth"] + 1, a["out"])).when(x == ")", state(F.when(a["depth"] > 0, a["depth"] - 1).otherwise(F.lit(1_000_000)), a["out"])).when(a["depth"] == 0, state(a["depth"], F.concat(a["out"], x))).otherwise(a)
    found = once(F.aggregate(parts, state(F.lit(0), F.lit("")), step), lambda end: F.when(end["depth"] == 0, end["out"]).otherwise(text))
    return F.when(~text.contains("(") & ~text.contains(")"), text).otherwise(found)


def tokenize(text: Column) -> Column:
    """Residues of a sequence: comments in parentheses and white space go, `X[mod]` is one token.

    Null gives null. Other characters raise an error, as do brackets without a partner.
    """
    return once(text, _tokens)


def _tokens(text: Column) -> Column:
    wrong = F.raise_error(F.concat(F.lit("not a residue sequence: "), F.substring(text, 1, 80))).cast("array<string>")
    # Most sequences have no marks: their letters are their tokens.
    simple = lambda plain: F.when(plain.rlike(r"[^A-Za-z0-9.]"), wrong).when(plain == "", F.array().cast("array<string>")).otherwise(F.split(F.upper(plain), "(?!^)(?!$)"))
    upper = lambda t: F.when(F.char_length(t) == 1, F.upper(t)).otherwise(F.concat(F.upper(F.substring(t, 1, 1)), F.substring(t, F.lit(2), F.char_length(t))))
    tokens = lambda clean: F.transform(F.regexp_extract_all(clean, F.lit(r"([A-Za-z0-9.](?:\[[^\[\]]*\])?)")), upper)
    # A bracket belongs to the letter before it, the last one of its run.
    marked = lambda clean: F.when(F.regexp_replace(clean, r"[A-Za-z0-9.]+(?:\[[^\[\]]*\])?", "") == "", tokens(clean)).otherwise(wrong)
    bare = once(F.regexp_replace(text, r"\s+", ""), simple)
    return F.when(text.isNull(), None).when(text.rlike(r"[\[\]()]"), once(F.regexp_replace(without_comments(text), r"\s+(?![^\[]*\])", ""), marked)).otherwise(bare)


def letters(text: Column) -> Column:
    """The ASCII letters of any text as upper-case residues."""
    return F.filter(F.split(F.upper(F.regexp_replace(text, "[^A-Za-z]+", "")), ""), lambda c: c != "")


def letter_text(text: Column) -> Column:
    """The same as one string, for sequences without modifications: far quicker to cut and count."""
    return F.upper(F.regexp_replace(text, "[^A-Za-z]+", ""))


def cut_pattern(*enzymes: str) -> str:
    """A pattern that matches between the letters where any of the enzymes cuts: a rule that cuts matches, and no later one that doesn't."""
    ways = []
    for enzyme in enzymes:
        rules = [(cut, _around(rule)) for cut, rule in ENZYMES[enzyme]]
        for i, (cut, here) in enumerate(rules):
            if cut:
                ways.append(here + "".join(f"(?!{later})" for keep, later in rules[i + 1 :] if not keep))
    return f"(?:{'|'.join(ways)})(?<=.)(?=.)"


def _around(rule: str) -> str:
    before, after = ([x.strip() for x in side.split(",")] for side in rule.split(";"))
    behind, ahead = ("".join(f"[{x}]" if x else "." for x in side) for side in (before if any(before) else [], after if any(after) else []))
    return (f"(?<={behind})" if behind else "") + (f"(?={ahead})" if ahead else "")


def cut_text(text: Column, *enzymes: str) -> Column:
    """Pieces of a letter text between the cuts of all enzymes; none of an empty text."""
    whole = F.split(text, cut_pattern(*enzymes)) if enzymes else F.array(text)
    return F.when(text == "", F.array().cast("array<string>")).otherwise(whole)


def stops(pieces: Column) -> Column:
    """Where each piece ends: running sums of lengths."""
    return F.aggregate(pieces, F.array().cast("array<int>"), lambda a, x: F.concat(a, F.array(F.coalesce(F.element_at(F.when(F.size(a) > 0, a).otherwise(F.array(F.lit(0))), -1), F.lit(0)) + F.char_length(x))))


def held_text(text: Column, residues: str) -> Column:
    """How many letters are among the residues."""
    return F.char_length(text) - F.char_length(F.translate(text, residues, ""))


def flu_text(text: Column, labels: list[str], n_cycles: int) -> Column:
    """flu() of a letter text."""
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    shown = "".join(next((str(i) for i, residues in enumerate(labels) if c in residues), ".") for c in alphabet)
    tail = F.substring(text, F.lit(n_cycles + 1), F.char_length(text))
    counts = [F.least(F.lit(99), held_text(tail, residues)).cast("string") for residues in labels]
    return F.concat(F.rpad(F.translate(F.substring(text, 1, n_cycles), alphabet, shown), n_cycles, " "), F.lit(" ;"), F.concat_ws(",", *counts))


def flu_text_counts(text: Column, labels: list[str], n_cycles: int) -> dict[str, Column]:
    """flu_counts() of a letter text."""
    head, tail = F.substring(text, 1, n_cycles), F.substring(text, F.lit(n_cycles + 1), F.char_length(text))
    every, by = "".join(labels), [held_text(text, r) for r in labels]
    return {"n_head_all_ch": held_text(head, every), "n_tail_all_ch": held_text(tail, every), "n_dyes_all_ch": held_text(text, every), "n_dyes_max_any_ch": F.greatest(*by) if len(by) > 1 else by[0]}


def dyeseq(text: Column, labels: list[str]) -> Column:
    """The pattern over a whole peptide without what follows its last label; empty if it has none."""
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    shown = "".join(next((str(i) for i, residues in enumerate(labels) if c in residues), ".") for c in alphabet)
    return F.regexp_replace(F.translate(text, alphabet, shown), r"\.+$", "")


def is_symbol(text: Column) -> Column:
    """Whether a text is a name: a letter or underscore, then letters, digits and underscores."""
    return F.coalesce(text.rlike(r"^[A-Za-z_][A-Za-z0-9_]*$"), F.lit(False))


def as_symbol(text: Column) -> Column:
    """A text as a name: other characters become underscores, a leading digit gets one before it."""
    clean = F.regexp_replace(text, r"[^A-Za-z0-9_]", "_")
    return F.when(clean.rlike(r"^[0-9]"), F.concat(F.lit("_"), clean)).otherwise(clean)


def shuffled(tokens: Column, *keys: Column, seed: int = 1) -> Column:
    """The same residues in an order that depends on seed and keys alone."""
    return F.transform(F.array_sort(F.transform(tokens, lambda t, i: F.struct(F.xxhash64(F.lit(seed), *keys, i).alias("u"), i.alias("i"), t.alias("t")))), lambda x: x["t"])


def join_tokens(tokens: Column) -> Column:
    return F.array_join(tokens, "")


def rule_parts(rule: str) -> list[tuple[int, str]]:
    """(offset from the cut, residues): -1 is the residue before the cut, 0 the one after it."""
    before, after = ([x.strip() for x in side.split(",")] for side in rule.split(";"))
    sides = [(i - len(before), x) for i, x in enumerate(before)] + list(enumerate(after))
    return [(offset, residues) for offset, residues in sides if residues]


def is_cut(tokens: Column, at: Column, enzyme: str) -> Column:
    """Whether the enzyme cuts before position `at` (from 0) of tokens: the last rule that matches decides."""
    cut = F.lit(False)
    for keep, rule in ENZYMES[enzyme]:
        match = F.lit(True)
        for offset, residues in rule_parts(rule):
            there = F.when(at + offset >= 0, F.substring(F.get(tokens, at + offset), 1, 1))
            match &= F.coalesce(there.isin(*residues), F.lit(False))
        cut = F.when(match, F.lit(keep)).otherwise(cut)
    return cut


def fragments(tokens: Column, *enzymes: str) -> Column:
    """array<struct<start, stop>>: half-open pieces between the cuts of all enzymes; one piece without enzymes."""
    n = F.size(tokens)
    inner = F.when(n > 1, F.sequence(F.lit(1), n - 1)).otherwise(F.array().cast("array<int>"))
    cuts = F.filter(inner, lambda i: _any(tokens, i, enzymes))
    starts = F.concat(F.array(F.lit(0)), cuts)
    stops = F.concat(cuts, F.array(n))
    return F.when(n > 0, F.zip_with(starts, stops, lambda a, b: F.struct(a.alias("start"), b.alias("stop")))).otherwise(F.array().cast("array<struct<start:int,stop:int>>"))


def _any(tokens: Column, at: Column, enzymes: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for enzyme in enzymes:
        out |= is_cut(tokens, at, enzyme)
    return out


def piece(tokens: Column, span: Column) -> Column:
    return F.slice(tokens, span["start"] + 1, span["stop"] - span["start"])


def mirrored_sites(sites: Column, n: Column) -> Column:
    """1-based modification sites of a reversed sequence, in order; null and '' stay empty."""
    return F.array_join(F.transform(F.array_sort(F.transform(split_sites(sites), lambda x: n - x + 1)), lambda x: x.cast("string")), ";")


def split_sites(sites: Column) -> Column:
    """Integers of a `;`-joined list of 1-based sites."""
    return F.transform(F.filter(F.split(F.coalesce(sites, F.lit("")), ";"), lambda s: F.trim(s) != ""), lambda s: F.trim(s).cast("int"))


def sites_in(sites: Column, start: Column, stop: Column) -> Column:
    """Those of a protein's sites that lie in the half-open piece, 1-based in the piece."""
    return F.transform(F.filter(split_sites(sites), lambda s: (s > start) & (s <= stop)), lambda s: s - start)


def held(tokens: Column, residues: str) -> Column:
    """How many tokens begin with one of the residues."""
    return F.size(F.filter(tokens, lambda t: F.substring(t, 1, 1).isin(*residues)))


def flu(tokens: Column, labels: list[str], n_cycles: int) -> Column:
    """The labelled pattern: channel digits or dots for the first n_cycles residues, then counts by channel in the rest."""
    channel = lambda t: F.coalesce(*[F.when(F.substring(t, 1, 1).isin(*residues), F.lit(str(i))) for i, residues in enumerate(labels)], F.lit("."))
    head = F.rpad(F.array_join(F.transform(F.slice(tokens, 1, n_cycles), channel), ""), n_cycles, " ")
    tail = F.slice(tokens, n_cycles + 1, F.greatest(F.lit(1), F.size(tokens)))
    counts = [F.least(F.lit(99), held(tail, residues)).cast("string") for residues in labels]
    return F.concat(head, F.lit(" ;"), F.concat_ws(",", *counts))


def flu_counts(tokens: Column, labels: list[str], n_cycles: int) -> dict[str, Column]:
    """Dyes in head and tail, in all, and the most in any channel."""
    head, tail = F.slice(tokens, 1, n_cycles), F.slice(tokens, n_cycles + 1, F.greatest(F.lit(1), F.size(tokens)))
    by = [held(tokens, r) for r in labels]
    total = lambda xs: sum(xs[1:], xs[0])
    return {"n_head_all_ch": total([held(head, r) for r in labels]), "n_tail_all_ch": total([held(tail, r) for r in labels]), "n_dyes_all_ch": total(by), "n_dyes_max_any_ch": F.greatest(*by) if len(by) > 1 else by[0]}


def is_proline_second(tokens: Column) -> Column:
    return F.coalesce(F.substring(F.get(tokens, F.lit(1)), 1, 1) == "P", F.lit(False))
