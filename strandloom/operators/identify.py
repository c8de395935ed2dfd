"""From reads and a configuration to barcodes, payloads, identifiers and routes.

Reads have a unique key and a column r1, r2, ... (struct with seq and qual) per mate. Each chain of
the configuration is read from left to right; at each hole the alternatives are tried in order, each
at its own shifts and lengths, and the first hit counts. A hit is found by equality joins only, with
the whitelist expanded (sparse types) or the missed read expanded (dense types).

A read goes through all holes as one row with a column for each hole; chains that begin alike share
theirs. Arrays of codes are made at the end only, and looked at by place and not by functions of
elements, which Spark doesn't compile: a row's code has to stay small to be compiled at all. Sparse types are looked
up in that row by broadcast joins, so that reads are neither shuffled nor written: of a whitelist that
is large when expanded only what the reads have at the hole is kept, for which they are read once
more. Where that is still too large, at a hole with more than MOST_TRIES tries, and for dense types a
read becomes a row per try, which are put together again by the key; only dense types write the reads
between the holes.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.operators import barcode as B
from strandloom.operators.skew import skew_join
from strandloom.sources.config import Config, Identifier
from strandloom.storage import BROADCAST_ROWS, materialise, maybe_broadcast

#: Tries of a hole up to which each is a broadcast join of its own.
MOST_TRIES = 32
#: Modes of correction by the names of the command line. Without a dense type none is needed.
MODES = {"default": "atact", "-": "atact", "atact": "atact", "rnat": "rnat", "fcfg": "fcfg", "minq": "minq"}
NOT_FOUND = "NOT_FOUND"
_CODES = "array<struct<type:string,code:string,text:string>>"

Find = Callable[[DataFrame, str], DataFrame]


def _apart(df: DataFrame) -> DataFrame:
    """`df` itself, whose rows Spark makes in a method of their own: the JVM compiles none of more than 8,000 bytes."""
    return df.coalesce(1 << 20)


def whitelists(reads: DataFrame, config: Config, given: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """type -> (ord, seq, name) of the types that are looked up: from the configuration, or as given (ord, seq, perhaps name)."""
    out = {}
    for kind, t in config.types.items():
        if given and kind in given:
            own = given[kind]
            named = F.col("name") if "name" in own.columns else F.concat(F.lit(f"{kind}:"), F.col("seq"))
            out[kind] = own.select("ord", F.upper("seq").alias("seq"), named.alias("name"))
        elif t.whitelist and not t.verbatim and not t.random and not t.payload:
            out[kind] = reads.sparkSession.createDataFrame([(i, s.upper(), n) for i, (n, s) in enumerate(t.whitelist)], "ord bigint, seq string, name string")
    return out


def _equal(config: Config, white: dict[str, DataFrame]) -> Find:
    """Adds _code and _text by equality with the whitelists."""
    table = None
    for kind, words in white.items():
        near = B.expand(words.select("ord", "seq"), 0).select("ord", F.col("variant").alias("_sub"))
        own = near.join(words.select("ord", "name"), "ord").select(F.lit(kind).alias("_type"), "_sub", F.col("ord").cast("string").alias("_code"), F.col("name").alias("_text"))
        table = own if table is None else table.unionByName(own)
    sized = None if table is None else maybe_broadcast(materialise(table, "words"))
    nothing = F.lit(None).cast("string")
    return lambda tried, key: tried.withColumns({"_code": nothing, "_text": nothing}) if sized is None else tried.join(sized, ["_type", "_sub"], "left")


class _Lookup:
    """Whitelists expanded by the mismatches of their types (not if `exact`), as tables _sub, _code, _text with a row for each _sub."""

    def __init__(self, config: Config, white: dict[str, DataFrame], exact: bool = False):
        self.white, self.mismatch = white, {kind: 0 if exact else config.types[kind].mismatch for kind in white}
        self.whole: dict[str, DataFrame | None] = {}
        self.held: dict[tuple, dict[str, DataFrame]] = {}
        self.by_rows = False

    def _table(self, kind: str, among: DataFrame | None = None) -> DataFrame:
        words = self.white[kind]
        names = words.groupBy("ord").agg(F.min("name").alias("_text"))
        near = B.expand(words.select("ord", "seq"), self.mismatch[kind], among=among).select("ord", F.col("variant").alias("_sub"))
        return maybe_broadcast(materialise(near.join(names, "ord").select("_sub", F.col("ord").cast("string").alias("_code"), "_text"), "words"))

    def _small(self, kind: str) -> DataFrame | None:
        """The whole table if it has at most BROADCAST_ROWS rows."""
        if kind not in self.whole:
            rows, longest = self.white[kind].select("seq").limit(BROADCAST_ROWS + 1).agg(F.count(F.lit(1)), F.coalesce(F.max(F.length("seq")), F.lit(0))).first()
            variants = sum(math.comb(longest, k) * len(B.LETTERS) ** k for k in range(self.mismatch[kind] + 1))
            self.whole[kind] = self._table(kind) if rows * variants <= BROADCAST_ROWS else None
        return self.whole[kind]

    def tables(self, place: tuple, tried: dict[str, list[Column]], state: DataFrame) -> dict[str, DataFrame]:
        """kind -> table of the kinds that are `tried`; of large ones what `state` has there. Chains that agree up to `place` share them."""
        if place not in self.held:
            large = [kind for kind in tried if self._small(kind) is None]
            seen = {}
            if large:
                subs = [F.struct(F.lit(kind).alias("type"), sub.alias("variant")) for kind in large for sub in tried[kind]]
                had = state.select((F.explode(F.array(*subs)) if len(subs) > 1 else subs[0]).alias("s"))
                rows = materialise(had.select("s.type", "s.variant").filter("variant is not null").distinct(), "seen")
                seen = {kind: self._table(kind, rows.filter(F.col("type") == kind).select("variant")) for kind in large}
            self.held[place] = {kind: seen.get(kind, self.whole[kind]) for kind in tried}
        return self.held[place]


def _broadcast(df: DataFrame) -> bool:
    """Whether `df` has a broadcast hint."""
    return df._jdf.queryExecution().logical().getClass().getSimpleName() in ("ResolvedHint", "UnresolvedHint")


def _dense(config: Config, white: dict[str, DataFrame], mode: str, priors: DataFrame | None) -> Find:
    """As _equal, and a row more for each try before a read's first exact hit that `mode` corrects."""
    equal = _equal(config, white)

    def find(tried: DataFrame, key: str) -> DataFrame:
        exact = equal(tried, key)
        best = exact.filter("_code is not null").groupBy(key).agg(F.min("_rank").alias("_best"))
        missed = tried.select(key, "_rank", "_type", "_sub", "_phred").join(best, key, "left").filter("_best is null or _rank < _best").withColumn("_id", F.struct(key, "_rank"))
        out = exact
        for kind, words in white.items():
            if config.types[kind].mismatch:
                own = priors.filter(F.col("type") == kind).select("ord", "prior") if priors is not None else None
                fixed = B.resolve(missed.filter(F.col("_type") == kind).select("_id", "_sub", "_phred"), words.select("ord", "seq"), "_id", "_sub", "_phred", mode, own, config.types[kind].mismatch)
                named = fixed.join(maybe_broadcast(words.select("ord", "name")), "ord")
                out = out.unionByName(named.select(F.col(f"_id.{key}").alias(key), F.col("_id._rank").alias("_rank"), F.col("ord").cast("string").alias("_code"), F.col("name").alias("_text")), allowMissingColumns=True)
        return out

    find.several = True
    return find


def _hole(state: DataFrame, key: str, names: tuple[str, ...], config: Config, find: Find | _Lookup, place: tuple, out: str) -> DataFrame:
    """`state` with the hole's barcode (type, code, text) as column `out` and the cursor moved to its end.

    Without a hit the code is null and the cursor moves by space and longest length of the last
    alternative. place: mate, start and holes of the chain up to this one.
    """
    tries = [(kind, config.types[kind].space + shift, size) for kind in names for shift in range(config.types[kind].laxity + 1) for size in range(config.types[kind].length[0], config.types[kind].length[1] + 1)]
    if not tries:
        raise ValueError(f"no length is known for {names}")
    part = lambda c, skip, size: F.substr(c, F.col("_pos") + skip, F.lit(size))
    plain = {kind: config.types[kind] for kind in names if config.types[kind].verbatim or config.types[kind].random}
    rank = F.col("_hit._rank")

    def at(values: list) -> Column:
        return F.when(rank.isNotNull(), F.lit(values[0])) if len(set(values)) == 1 else F.get(F.array(*[F.lit(v) for v in values]), rank)

    last = config.types[names[-1]]
    ends, none = [skip + size for _, skip, size in tries], last.space + last.length[1]
    move = F.lit(none) if {*ends} == {none} else F.coalesce(at(ends), F.lit(none))
    code = F.struct(at([kind for kind, _, _ in tries]).alias("type"), F.col("_hit._code").alias("code"), F.col("_hit._text").alias("text"))
    moved = [*[c for c in state.columns if c != "_pos"], (F.col("_pos") + move).alias("_pos"), code.alias(out)]

    if isinstance(find, _Lookup):
        whole = [F.when(F.length(part("_seq", skip, size)) == size, F.upper(part("_seq", skip, size))) for _, skip, size in tries]
        sought = {kind: [sub for sub, (k, _, _) in zip(whole, tries) if k == kind] for kind in names if kind in find.white and kind not in plain}
        tables = find.tables(place, sought, state)
        if sum(map(len, sought.values())) <= MOST_TRIES and all(map(_broadcast, tables.values())):
            hits, found = [], state
            for i, (sub, (kind, _, _)) in enumerate(zip(whole, tries)):
                if kind in plain:
                    own = F.when(sub.rlike("^[ACGT]+$") if plain[kind].random else sub.isNotNull(), F.struct(F.lit(i).alias("_rank"), (sub if plain[kind].random else F.lit("*")).alias("_code"), F.concat(F.lit(f"{kind}:"), sub).alias("_text")))
                elif kind in tables:
                    found = found.withColumn("_sub", sub).join(tables[kind], "_sub", "left").withColumnsRenamed({"_code": f"_code_{i}", "_text": f"_text_{i}"}).drop("_sub")
                    own = F.when(F.col(f"_code_{i}").isNotNull(), F.struct(F.lit(i).alias("_rank"), F.col(f"_code_{i}").alias("_code"), F.col(f"_text_{i}").alias("_text")))
                else:
                    continue
                hits.append(own)
            hit = F.coalesce(*hits) if hits else F.lit(None).cast("struct<_rank:int,_code:string,_text:string>")
            return _apart(found.select(*state.columns, hit.alias("_hit")).select(*moved))
        find.by_rows = True

    array = F.array(*[F.struct(F.lit(i).alias("rank"), F.lit(kind).alias("type"), F.upper(part("_seq", skip, size)).alias("sub"), part("_qual", skip, size).alias("qual"), F.lit(size).alias("size")) for i, (kind, skip, size) in enumerate(tries)])
    whole = F.filter(array, lambda t: F.length(t["sub"]) == t["size"])
    if getattr(find, "several", False):
        state = materialise(state, "state")
    tried = state.select("*", F.explode_outer(whole).alias("t")).select(*state.columns, F.col("t.rank").alias("_rank"), F.col("t.type").alias("_type"), F.col("t.sub").alias("_sub"), F.col("t.qual").alias("_phred"))
    if isinstance(find, _Lookup):
        found, parts = None, [t.select(F.lit(kind).alias("_type"), "_sub", "_code", "_text") for kind, t in tables.items()]
        for t in parts:
            found = t if found is None else found.unionByName(t)
        found = tried.join(found, ["_type", "_sub"], "left")
    else:
        found = find(tried, key)
    for kind, t in plain.items():
        own = (F.col("_type") == kind) & (F.col("_sub").rlike("^[ACGT]+$") if t.random else F.lit(True))
        code = F.col("_sub") if t.random else F.lit("*")
        found = found.withColumns({"_code": F.when(own, code).otherwise(F.col("_code")), "_text": F.when(own, F.concat("_type", F.lit(":"), "_sub")).otherwise(F.col("_text"))})
    hit = F.min(F.when(F.col("_code").isNotNull(), F.struct("_rank", "_code", "_text"))).alias("_hit")
    first = found.groupBy(key).agg(hit, *[F.any_value(c, True).alias(c) for c in state.columns if c != key])
    return first.select(*moved)


def _payload(state: DataFrame, length: int) -> DataFrame:
    """`state` with what stands at the cursor: `length` bases, or all the rest; null where nothing is left."""
    cut = (lambda c: F.substr(c, F.col("_pos"), F.lit(length))) if length else (lambda c: F.substr(F.col(c), F.col("_pos")))
    found = F.when(F.col("_pos") <= F.length("_seq"), F.struct(cut("_seq").alias("seq"), cut("_qual").alias("qual")))
    return state.withColumn("_payload", found).withColumn("_pos", F.col("_pos") + length if length else F.coalesce(F.length("_seq"), F.lit(0)) + 1)


def _scan(reads: DataFrame, key: str, config: Config, find: Find | _Lookup) -> DataFrame:
    """key, codes, genome, full, payload_1..4: the first kind of genome whose chains are found whole, else the last, with the common chains."""
    mates = sorted({ch.mate for ch in config.chains})
    state = _apart(reads.select(key, *[F.col(f"r{m}.{f}").alias(f"_{f}_{m}") for m in mates for f in ("seq", "qual")]))
    held: dict[tuple, tuple[str, str]] = {}
    holes: list[list[str]] = []
    for c, chain in enumerate(config.chains):
        state = state.withColumns({"_seq": F.col(f"_seq_{chain.mate}"), "_qual": F.col(f"_qual_{chain.mate}"), "_pos": F.lit(chain.position), "_payload": F.lit(None).cast("struct<seq:string,qual:string>")})
        holes.append([])
        for h, names in enumerate(chain.holes):
            place = (chain.mate, chain.position, tuple(map(tuple, chain.holes[: h + 1])))
            if names[0].upper().startswith("GENOME"):
                known = config.types.get(names[0])
                state = _payload(state, known.length[0] if known else 0)
                continue
            if place in held:
                state = state.withColumn("_pos", F.col(held[place][1]))
            else:
                held[place] = (f"_h{len(held)}", f"_e{len(held)}")
                state = _hole(state, key, names, config, find, place, held[place][0]).withColumn(held[place][1], F.col("_pos"))
            holes[c].append(held[place][0])
        state = state.withColumn(f"_p{c}", F.col("_payload")).drop("_seq", "_qual", "_pos", "_payload")

    def whole(columns: list[str]) -> Column:
        ok = F.lit(True)
        for one in dict.fromkeys(columns):
            ok = ok & F.col(one)["code"].isNotNull()
        return ok

    taken = _taken(config)
    kinds = [kind for kind in taken if kind is not None]
    genome = F.lit(kinds[-1] if kinds else None).cast("string")
    for kind in reversed(kinds[:-1]):
        genome = F.when(whole([x for own, ch in zip(holes, config.chains) if ch.genome == kind for x in own]), kind).otherwise(genome)
    state = state.withColumn("genome", genome)
    codes = full = None
    for kind in reversed(taken):
        own = [x for c in taken[kind] for x in holes[c]]
        array, found = F.array(*own).cast(_CODES), whole(own)
        codes = array if codes is None else F.when(F.col("genome") == kind, array).otherwise(codes)
        full = found if full is None else F.when(F.col("genome") == kind, found).otherwise(full)
    takes = [F.lit(True) if ch.genome is None else F.col("genome") == ch.genome for ch in config.chains]
    payloads = {m: [F.when(t, F.col(f"_p{c}")) for c, (t, ch) in enumerate(zip(takes, config.chains)) if ch.mate == m] for m in mates}
    return _apart(state).select(key, codes.alias("codes"), "genome", *[F.coalesce(*p).alias(f"payload_{m}") for m, p in payloads.items()], full.alias("full"))


def _taken(config: Config) -> dict[str | None, list[int]]:
    """Kind of genome -> chains that are taken for it, the common ones included; without any kind there is None."""
    kinds = list(dict.fromkeys(ch.genome for ch in config.chains if ch.genome)) or [None]
    return {kind: [c for c, ch in enumerate(config.chains) if ch.genome in (None, kind)] for kind in kinds}


def _fits(identifier: Identifier, most: int) -> tuple[Column, Callable[[Column], Column]]:
    """(first place in the codes of a read, of which there are at most `most`, where the identifier's pattern fits, or null; the key by that place).

    A pattern with places stands there, one without at its first fit from the left. ANY fits whatever
    stands there, found or not, and isn't part of the key; neither is a hole with several kinds, so
    that the reads of both share an id.
    """
    offsets, at = [], -1
    for place, _ in identifier.pattern:
        at = place - 1 if place is not None else at + 1
        offsets.append(at)

    def fits(i: int) -> Column:
        ok = F.lit(True) if identifier.anchored else F.size("codes") > i + offsets[-1]
        for k, (_, types) in enumerate(identifier.pattern):
            if types is not None:
                x = F.get(F.col("codes"), F.lit(i + offsets[k]))
                ok = ok & x["code"].isNotNull() & x["type"].isin(list(types))
        return F.when(ok, F.lit(i))

    places = [0] if identifier.anchored else range(most - offsets[-1])
    first = F.coalesce(F.lit(None).cast("int"), *map(fits, places))
    fixed = [k for k, (_, types) in enumerate(identifier.pattern) if types is not None and len(types) == 1]
    key = lambda i: F.concat_ws("-", *[F.get(F.col("codes"), i + offsets[k])["code"] for k in fixed]) if fixed else F.lit("")
    return first, lambda i: F.when(i.isNotNull(), key(i))


def identify(reads: DataFrame, key: str, config: Config, mode: str = "default", given: dict[str, DataFrame] | None = None, partial: bool = False, numbered: bool = True) -> DataFrame:
    """Barcodes, payloads, identifiers and route of each read.

    Columns: `key`; `codes` (type, code, text of each hole; null where not found); `full`; `genome`
    (kind of the chains taken); payload_1.. (seq, qual) of the mates with chains; a bigint column per
    identifier, null where its pattern doesn't fit; `type` (DNA, RNA or NDNR, by the identifiers of
    those names); `route` (the type, null for reads that aren't written: those not full, or with
    `partial` none, which then have _all behind it); `label` (barcodes and ids as names carry them).

    mode: see MODES. atact goes in two rounds: exact hits first, whose counts weigh the candidates
    of the reads that are not full. Without a dense type mismatches are those of the expanded
    whitelists. given: whitelists (ord, seq, perhaps name) by type that stand elsewhere. Without
    `numbered` the identifiers are left out, in the label too, which saves a pass over the reads. Null
    or short mates find nothing; keys must be unique; an empty table gives no rows.
    """
    mode = MODES[mode]
    mates = [f"r{m}" for m in sorted({ch.mate for ch in config.chains})]
    reads = reads.select(key, *mates)
    white = whitelists(reads, config, given)
    sparse = None
    if not any(t.dense for t in config.types.values()):
        sparse = _Lookup(config, white)
        done = _scan(reads, key, config, sparse)
    elif mode == "atact":
        first = materialise(_scan(reads, key, config, _Lookup(config, white, exact=True)), "exact")
        hits = first.select(F.explode("codes").alias("c")).filter(F.col("c.code").isNotNull() & F.col("c.type").isin(list(white)))
        priors = materialise(hits.groupBy(F.col("c.type").alias("type"), F.col("c.code").cast("bigint").alias("ord")).agg(F.count(F.lit(1)).alias("prior")), "priors")
        rest = materialise(reads.join(first.filter(~F.col("full")).select(key), key, "left_semi"), "rest")
        done = first.filter("full").unionByName(_scan(rest, key, config, _dense(config, white, mode, priors)))
    else:
        done = _scan(reads, key, config, _dense(config, white, mode, None))
    most = max(sum(1 for c in own for names in config.chains[c].holes if not names[0].upper().startswith("GENOME")) for own in _taken(config).values())
    kind = F.lit("NDNR")
    for one in config.identifiers:
        if one.name in ("DNA", "RNA"):
            kind = F.when(_fits(one, most)[0].isNotNull(), one.name).otherwise(kind)
    others = [one for one in config.identifiers if numbered and one.name not in ("DNA", "RNA")]
    counted = F.col("full") | F.lit(partial)
    placed = _apart(done).withColumns({"type": kind, **{f"_at_{j}": F.when(counted, _fits(one, most)[0]) for j, one in enumerate(others)}})
    keyed = placed.select(*done.columns, "type", *[_fits(one, most)[1](F.col(f"_at_{j}")).alias(f"_key_{j}") for j, one in enumerate(others)])
    if sparse is None or sparse.by_rows:
        keyed = materialise(keyed, "identified")
    tables = {}
    for j, one in enumerate(others):
        # the reads are gone through once more for their distinct keys; writing them takes many times their size
        keys = materialise(keyed.select(f"_key_{j}").filter(F.col(f"_key_{j}").isNotNull()).distinct(), "keys")
        tables[f"_key_{j}"] = maybe_broadcast(materialise(B.assign_ids(keys, f"_key_{j}").select(f"_key_{j}", F.col("id").alias(one.name)), "ids"))
    if not all(map(_broadcast, tables.values())) and sparse is not None and not sparse.by_rows:
        keyed = materialise(keyed, "identified")
    for column, ids in tables.items():
        keyed = keyed.join(ids, column, "left") if _broadcast(ids) else skew_join(keyed, ids, column, "left")
    texts = F.array_join(F.transform("codes", lambda x: F.coalesce(x["text"], F.lit(NOT_FOUND))), "|")
    names = [F.coalesce(F.concat(F.lit(f"{one.name}_"), F.col(one.name).cast("string")), F.lit(NOT_FOUND)) for one in others]
    label = F.concat_ws("|||", texts, F.concat_ws("|", *names)) if names else texts
    route = F.when(F.col("full") | F.lit(partial), F.concat("type", F.lit("_all" if partial else "")))
    payloads = [c for c in keyed.columns if c.startswith("payload_")]
    return keyed.select(key, "codes", "full", "genome", *payloads, *[one.name for one in others], "type", route.alias("route"), label.alias("label"))


def fastq_rows(identified: DataFrame, names: DataFrame, key: str) -> DataFrame:
    """What the FASTQ sink writes: name (with the label), seq, qual, `route`, `mate`.

    names: key and `name` of each read; what follows a / or blank in it is cut. A mate without payload gives no row.
    """
    mates = [c for c in identified.columns if c.startswith("payload_")]
    parts = F.array(*[F.struct(F.lit(int(c.split("_")[1])).alias("mate"), F.col(f"{c}.seq").alias("seq"), F.col(f"{c}.qual").alias("qual")) for c in mates])
    rows = identified.filter("route is not null").join(names.select(key, F.regexp_replace("name", "[/ ].*$", "").alias("_read")), key)
    return rows.select(F.concat_ws("|||", "_read", "label").alias("name"), "route", F.explode(parts).alias("p")).select("name", "p.seq", "p.qual", "route", "p.mate").filter("seq is not null")
