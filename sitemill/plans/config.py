"""Typed settings with their defaults, and the command line that reproduces them."""

from __future__ import annotations

from dataclasses import asdict, dataclass, fields


@dataclass(frozen=True)
class Settings:
    """One object for a whole batch; nothing is passed on by hand, so nothing gets lost on the way."""

    umi_length: int = 7
    barcode_length: int = 0
    spacer_length: int = 0
    barcode_first: bool = False
    min_length: int = 16
    min_quality: float = 30.0
    max_mismatches: int = 1
    min_mapq: int = 255
    max_nh: int = 1
    multi_map: bool = False
    rescue_window: int = 50
    filter_chromosomes: bool = True
    min_coverage: int = 5
    min_fraction: float = 0.05
    min_signal: int = 1
    fdr: float = 0.05
    cluster_gap: int = 25
    no_subs: bool = False
    sub_types: str = ""
    peak_distance: int = 50
    peak_size: int = 20
    fragment_length: int = 25
    cims_iterations: int = 5
    cims_fdr: float = 1.0
    cits_pvalue: float = 0.001
    cits_gap: int = 25
    flank: int = 10
    raw_counts: bool = False
    coverage_stats: bool = False
    site_columns: bool = False

    def diff_vs_default(self) -> dict[str, object]:
        return {f.name: getattr(self, f.name) for f in fields(self) if getattr(self, f.name) != f.default}

    def to_cli(self) -> list[str]:
        """Flags of the settings that differ from their defaults."""
        out: list[str] = []
        for name, value in self.diff_vs_default().items():
            flag = "--" + name.replace("_", "-")
            out += [flag] if value is True else [f"--no-{name.replace('_', '-')}"] if value is False else [flag, str(value)]
        return out

    @classmethod
    def from_strings(cls, values: dict[str, str]) -> Settings:
        """Checks and converts text values; unknown names and wrong types raise."""
        kinds = {f.name: type(f.default) for f in fields(cls)}
        out: dict[str, object] = {}
        for k, v in values.items():
            if k not in kinds:
                raise KeyError(k)
            out[k] = v.strip().lower() in ("y", "yes", "true", "1") if kinds[k] is bool else kinds[k](v)
        return cls(**out)  # type: ignore[arg-type]

    def as_dict(self) -> dict[str, object]:
        return asdict(self)


#: Numbered folders of a run; tracks take one more when they are made.
FOLDERS = ("reads", "alignments", "tags", "tracks", "pileups", "sites", "peaks", "matrix", "tag_sites", "reports")


def layout(root: str, with_tracks: bool = True) -> dict[str, str]:
    names = [f for f in FOLDERS if with_tracks or f != "tracks"]
    return {n: f"{root}/{i:02d}_{n}" for i, n in enumerate(names)}
