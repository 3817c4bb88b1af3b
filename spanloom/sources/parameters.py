"""Typed parameters with bounds, overridden by an assembly's text of name=value pairs."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product


@dataclass(frozen=True)
class Parameter:
    name: str
    kind: str
    default: object = None
    least: tuple[float, bool] | None = None  # bound, and whether it may be reached
    most: tuple[float, bool] | None = None
    allowed: tuple[str, ...] | None = None
    lower: bool = False
    text: str = ""
    advanced: bool = False

    def value(self, given: object) -> object:
        if given is None:
            return self.default
        if self.kind == "bool":
            return as_bool(given)
        if self.kind == "str":
            out = str(given).strip()
            out = out.lower() if self.lower else out
            if self.allowed and out not in self.allowed:
                raise ValueError(f"{self.name}: {out!r} isn't one of {', '.join(self.allowed)}")
            return out
        try:
            out = int(str(given)) if self.kind == "int" else float(str(given))
        except ValueError:
            raise ValueError(f"{self.name}: {given!r} isn't of kind {self.kind}") from None
        for bound, below in ((self.least, True), (self.most, False)):
            if bound is not None and (out < bound[0] if below else out > bound[0]) or bound is not None and out == bound[0] and not bound[1]:
                raise ValueError(f"{self.name}: {out} is out of bounds")
        return out


def as_bool(given: object) -> bool:
    low = str(given).strip().lower()
    if low in ("true", "t", "yes", "y", "1"):
        return True
    if low in ("false", "f", "no", "n", "0"):
        return False
    raise ValueError(f"neither true nor false: {given!r}")


def _p(name, kind, default=None, least=None, most=None, **how):
    bound = lambda x: None if x is None else x if isinstance(x, tuple) else (x, True)
    return Parameter(name, kind, default, bound(least), bound(most), **how)


PARAMETERS = {p.name: p for p in (
    _p("aligner", "str", "minimap2", allowed=("minimap2", "lra"), text="Alignment program"), _p("align_params", "str", text="Parameters of the aligner"), _p("lc_model", "str", "default", text="Model of low-confidence alignments", advanced=True),
    _p("align_score_model", "str", "affine::match=2.0,mismatch=4.0,gap=4.0:2.0;24.0:1.0", text="Score model", advanced=True), _p("redundant_callset", "bool", False, text="Variants are nonredundant by sequence, not overall", advanced=True),
    _p("align_trim_max_depth", "int", 20, 1, text="Depth from which on a place counts as deep", advanced=True), _p("align_trim_max_depth_prop", "float", 0.8, 0.0, 1.0, text="Most share of a record in deep places", advanced=True),
    _p("min_anchor_score", "str", "50bp", text="Least score of anchors"), _p("lg_gap_scale", "float", 0.2, (0.0, False), text="Factor of gap scores between anchors", advanced=True), _p("lg_smooth_segments", "float", 0.05, 0.0, text="Least share of a segment in a trace", advanced=True),
    _p("lg_cpx_min_aligned_prop", "float", 0.8, 0.0, 1.0, text="Least aligned share of complex variants", advanced=True), _p("vcf_haplotypes", "str", text="Haplotypes in a VCF, in order"),
    _p("inv_sig_cluster_flank", "int", 100, text="Flank of variants in clusters"), _p("inv_sig_cluster_win_min", "int", 500, text="Least cluster window"), _p("inv_sig_cluster_snv_min", "int", 20, text="Least depth of SNV clusters"), _p("inv_sig_cluster_indel_min", "int", 10, text="Least depth of indel clusters"),
    _p("inv_sig_cluster_varlen_min", "int", 1, text="Least indel in clusters"), _p("inv_sig_insdel_offset_prop", "float", 2.0, text="Most offset of matched insertions and deletions"), _p("inv_sig_insdel_varlen_ro", "float", 0.8, text="Least size overlap of them"), _p("inv_sig_merge_flank", "int", 1000, text="Flank of windows that merge"),
    _p("inv_max_overlap", "float", 0.2, 0.0, 1.0, text="Most overlap of inversions of a haplotype"), _p("inv_min", "int", 0, 0, text="Least inversion"), _p("inv_max", "int", 0, 0, text="Largest inversion, 0 for any"), _p("inv_region_limit", "int", 1_000_000, text="Largest region searched", advanced=True),
    _p("inv_min_expand", "int", 1, text="Expansions to try at least", advanced=True), _p("inv_init_expand", "int", 4000, text="First expansion", advanced=True), _p("inv_min_kmers", "int", 1000, text="Least number of k-mers", advanced=True), _p("inv_max_ref_kmer_count", "int", 10, text="Most copies of a k-mer", advanced=True),
    _p("inv_repeat_match_prop", "float", 0.15, text="Bonus of like repeats", advanced=True), _p("inv_min_kmer_run", "int", 100, text="Least run of inverted k-mers", advanced=True), _p("inv_min_qry_ref_prop", "float", 0.6, text="Least ratio of region sizes", advanced=True), _p("inv_k_size", "int", 31, text="K-mer size", advanced=True),
    _p("inv_kde_bandwidth", "float", 100.0, text="Bandwidth of densities", advanced=True), _p("inv_kde_trunc_z", "float", 3.0, text="Where densities are cut", advanced=True), _p("inv_kde_func", "str", "auto", allowed=("auto", "fft", "conv"), lower=True, text="Convolution", advanced=True),
    _p("verbose", "bool", False, text="Verbose output"), _p("debug", "bool", False, text="Extra checks", advanced=True),
)}


def settings(config: dict | None = None, override: str | None = None) -> dict[str, object]:
    """Values of all parameters: an assembly's own text before the configuration, before defaults; unknown names raise."""
    given = dict(config or {})
    for part in (x for x in (override or "").split(";") if x.strip()):
        name, mark, value = part.partition("=")
        if not mark:
            raise ValueError(f"not name=value: {part!r}")
        given[name.strip()] = value.strip()
    if unknown := [n for n in given if n not in PARAMETERS]:
        raise ValueError(f"unknown parameters: {unknown}")
    return {name: p.value(given.get(name)) for name, p in PARAMETERS.items()}


def help_text(advanced: bool = False) -> str:
    """All parameters as a list in Markdown."""
    rows = (p for p in PARAMETERS.values() if advanced or not p.advanced)
    return "\n".join(f"* {p.name} [{p.kind}{'' if p.default is None else f', {p.default}'}]: {p.text}" for p in rows)


def wildcards(pattern: str, assemblies: list[tuple[str, str]], **values: list[str]) -> list[str]:
    """A pattern with {assembly}, {hap} and other names filled in all ways, each result once."""
    out = []
    for (assembly, hap), *rest in product(assemblies, *values.values()):
        out.append(pattern.format(assembly=assembly, hap=hap, **dict(zip(values, rest))))
    return list(dict.fromkeys(out))


class Catalog:
    """Tables by name and tags."""

    def __init__(self):
        self.items: list[tuple[str, frozenset[str], object]] = []

    def add(self, name: str, item: object, *tags: str) -> None:
        self.items.append((name, frozenset(tags), item))

    def tagged(self, *tags: str, every: bool = True) -> list[object]:
        """Items with all of the tags, or with any of them."""
        return [x for _, own, x in self.items if (own.issuperset(tags) if every else own.intersection(tags))]

    def __getitem__(self, at):
        if isinstance(at, str):
            return next(x for n, _, x in self.items if n == at)
        return [x[2] for x in self.items[at]] if isinstance(at, slice) else self.items[at][2]
