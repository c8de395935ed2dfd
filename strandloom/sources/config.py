"""Method configurations: JSON with comment lines, and what it says as plain dataclasses."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field


@dataclass
class BarcodeType:
    """One kind of barcode: where and how it is looked for, and its whitelist as (name, sequence)."""

    name: str
    space: int = 0
    laxity: int = 0
    length: tuple[int, int] = (0, 0)
    mismatch: int = 0
    dense: bool = False
    random: bool = False
    whitelist: list[tuple[str, str]] = field(default_factory=list)

    @property
    def verbatim(self) -> bool:
        """Captured as it stands (a UMI): the whitelist is N alone."""
        return bool(self.whitelist) and all(set(s.upper()) == {"N"} for _, s in self.whitelist)

    @property
    def payload(self) -> bool:
        """What stands there is kept (of the given length, or all the rest)."""
        return self.name.upper().startswith("GENOME")


@dataclass
class Chain:
    """Holes (each with alternatives) read from a mate at a 1-based position."""

    holes: list[tuple[str, ...]]
    mate: int
    position: int
    genome: str | None = None


@dataclass
class Identifier:
    name: str
    pattern: list[tuple[int | None, tuple[str, ...] | None]]

    @property
    def anchored(self) -> bool:
        return any(place is not None for place, _ in self.pattern)


@dataclass
class Config:
    chains: list[Chain]
    types: dict[str, BarcodeType]
    identifiers: list[Identifier]
    sons: dict[str, str]
    ignored: list[str]

    def whitelist_rows(self) -> list[tuple[str, int, str, str]]:
        """(type, ord, seq, name) of all barcodes, for createDataFrame."""
        return [(t.name, i, s.upper(), n) for t in self.types.values() for i, (n, s) in enumerate(t.whitelist)]


def _key(text: str) -> str:
    return re.sub(r"\s+", "", text).lower()


def _whitelist(kind: str, entries) -> list[tuple[str, str]]:
    out = []
    for e in entries if isinstance(entries, list) else [entries]:
        out += [(f"{kind}:{e}", e)] if isinstance(e, str) else [(n, s) for n, s in e.items()]
    return out


def _type(name: str, spec: dict) -> BarcodeType:
    s = {_key(k): v for k, v in spec.items()}
    words = _whitelist(name, s.get("whitelist", []))
    lengths = re.findall(r"\d+", str(s.get("length", ""))) or [str(len(x)) for _, x in words[:1]] or ["0"]
    on = lambda k: str(s.get(k, "")).strip().lower() not in ("", "0", "false", "no", "none")
    return BarcodeType(name, int(s.get("space", 0)), int(s.get("laxity", 0)), (int(lengths[0]), int(lengths[-1])), int(s.get("mismatch", 0)), on("dense"), on("random"), words)


def _chain(text: str, place: str) -> Chain:
    where = re.fullmatch(r"\s*[Rr]([1-4]):(\d+)\s*", place)
    if not where:
        raise ValueError(f"not a place R<1-4>:<position>: {place}")
    holes = [tuple(a.split("|")[0] for a in hole.split("/")) for hole in text.split("-")]
    genome = next((h[0][6:7].upper() for h in holes if h[0].upper().startswith("GENOME") and len(h[0]) > 6), None)
    return Chain(holes, int(where[1]), int(where[2]), genome)


def _identifier(name: str, text: str) -> Identifier:
    pattern, last = [], 0
    for part in text.split("-"):
        place, _, names = part.rpartition(":")
        at = int(place) if place else None
        if at is not None:
            if at <= last:
                raise ValueError(f"places of {name} must ascend: {text}")
            last = at
        pattern.append((at, None if names.upper() == "ANY" else tuple(names.split("/"))))
    return Identifier(name, pattern)


def parse(text: str) -> Config:
    """A configuration; top-level keys in any case and spacing, unknown ones are listed as ignored."""
    lines = [x for x in text.splitlines() if not x.lstrip().startswith(("#", "//"))]
    tree = {_key(k): v for k, v in json.loads("\n".join(lines)).items()}
    pairs = lambda v: [kv for d in (v if isinstance(v, list) else [v]) for kv in d.items()]
    types = {n: _type(n, s) for n, s in pairs(tree.get("barcodetype", {}))}
    chains = [_chain(k, v) for k, v in pairs(tree.get("barcodechain", []))]
    for chain in chains:
        for names in chain.holes:
            missing = [n for n in names if n not in types and not n.upper().startswith("GENOME")]
            if missing:
                raise ValueError(f"barcode without a type: {missing}")
    known = {"barcodechain", "barcodetype", "identifier", "son"}
    return Config(chains, types, [_identifier(k, v) for k, v in pairs(tree.get("identifier", {}))], dict(pairs(tree.get("son", {}))), sorted(set(tree) - known))


def with_whitelist(config: Config, kind: str, rows: list[tuple[str, str]]) -> Config:
    """The configuration with another whitelist (name, sequence) for one type."""
    old = config.types[kind]
    words = rows or [(f"{kind}:NNNNN", "NNNNN")]
    new = BarcodeType(kind, old.space, old.laxity, (len(words[0][1]),) * 2, old.mismatch, old.dense, old.random, words)
    return Config(config.chains, {**config.types, kind: new}, config.identifiers, config.sons, config.ignored)


def field_spec(text: str) -> list[tuple[str, str]]:
    """Extra fields such as '3:UMI:UM-DPM:DP': (place, type or both; two-letter tag) of each."""
    out = []
    for part in text.split("-"):
        bits = part.split(":")
        tag = bits.pop() if len(bits) > 1 and len(bits[-1]) == 2 else bits[-1][:2].upper()
        out.append((":".join(bits), tag))
    return out
