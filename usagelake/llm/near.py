"""Near duplicates by ProbMinHash: signatures from Poisson arrivals, banding, exact verification, components.

The similarity is the probability Jaccard of weighted word shingles (weight: how often a shingle stands in the text):
the chance that two exponential races over the shingles have one winner. With weights of 1 it is the plain Jaccard.

Buckets of up to `SMALL` texts have all their pairs compared. Members of a larger bucket are compared with one centre,
the member of most company in all its buckets; after the components of all that joins, with the next centre, taken from
the classes that have none yet, and so on while a round joins anything. So the work is linear in the rows of buckets.
Signatures are compared first, then texts are verified in full.

What larger buckets leave open is found by a join on shingles. Open texts are members of such a bucket that are none of
its centres and, after the components of the links so far, not all of one class. Let u and v be the odds of what two texts
don't share (its weight : the weight of the rest). Their probability Jaccard is at most 1 / (1 + u + v), so at a
similarity s u + v is at most 1/s - 1. With shingles in one order (those of fewest open texts first), what comes before the
first shared one is not shared, so the odds of what comes before it in the one and in the other add up to no more than
that. Only texts of different classes meet there, if this bound holds and if sketches of 2048 bits differ in no more bits
than those of a pair at the threshold do in all but one of three million cases; that chance is all that the join leaves.

Defined results: null and wordless texts have no shingles and are joined to nothing but their exact copies; a text of
fewer words than a shingle is one shingle. Rows that share a doc_id are one member, linked by any of their texts. Rows
without doc_id are left out of the classes and never dropped by `drop_near`. An empty table gives an empty result. Columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from usagelake.llm.common import Scratch, digest, keep_rows, long_ids, small_batches, whole_text
from usagelake.llm.components import components
from usagelake.llm.words import ASCII_SPACE, U64, Hasher, flat, lists, mix, slices, spans, windows

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 5
#: Buckets of so many members have all their pairs compared; of a larger one, members are compared with at most so many
#: centres, one after the other.
SMALL, CENTRES = 9, 3
#: Texts of one shingle that meet in one task in the exact join are about so many; a shingle is spread over at most SALTS.
SALT_TEXTS, SALTS = 1000, 256
#: One-bit registers of an open text, in longs; a pair at the threshold differs in more of them than its mean and so many
#: deviations once in three million cases.
SKETCH, DEVIATIONS = 32, 5
#: Signatures of a pair at the threshold agree less often than this only once in some million cases.
SLACK = 0.17

_HASH = Hasher(11)
_STEP = U64(0x9E3779B97F4A7C15)


def _shingles(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles, and where each text's begin."""
    data, at = flat(texts)
    starts, ends, first = spans(data, at, ASCII_SPACE)
    a, b, begin = windows(first, words, short=True)
    return _HASH.runs(_HASH.words(data, starts, ends), a, b), begin


def _weighted(hashes: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text (up to 4096 texts): text number, hash of 52 bits, count."""
    doc = np.repeat(np.arange(len(begin) - 1, dtype=np.uint64), np.diff(begin))
    key = np.sort((doc << U64(52)) | (hashes >> U64(12)))
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.append(new, len(key)))
    key = key[new]
    return (key >> U64(52)).astype(np.int64), key & U64((1 << 52) - 1), count


def signatures(hashes: np.ndarray, begin: np.ndarray, size: int) -> np.ndarray:
    """For each text `size` registers, each the hash of the shingle that arrives there first (0: no shingles).

    A shingle of weight w is a Poisson process of rate w whose points fall into random registers. A shingle's next
    point is only made while it could still come before the latest first arrival of its text.
    """
    n = len(begin) - 1
    doc, element, weight = _weighted(hashes, begin)
    first, winner = np.full(n * size, np.inf), np.zeros(n * size, np.uint64)
    time, turn = np.zeros(len(doc)), 0
    while len(doc):
        turn += 1
        draw = mix(element + U64(turn * int(_STEP) & (1 << 64) - 1))
        time = time - np.log1p(-(draw >> U64(11)).astype(np.float64) * 2.0**-53) / weight
        at = doc * size + (mix(draw ^ _STEP) % U64(size)).astype(np.int64)
        early = np.flatnonzero(time < first[at])
        np.minimum.at(first, at[early], time[early])
        won = early[time[early] == first[at[early]]]
        winner[at[won]] = element[won] | U64(1 << 52)
        alive = np.flatnonzero(time < first.reshape(n, size).max(axis=1)[doc])
        if len(alive) < len(doc):
            doc, element, weight, time = doc[alive], element[alive], weight[alive], time[alive]
    return winner.reshape(n, size)


def _small(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        for i in range(0, batch.num_rows, 4096):
            yield batch.slice(i, 4096)


def _signer(words: int, bands: int, rows: int):
    salt = mix(np.arange(1, bands * rows + 1, dtype=np.uint64) * _STEP) | U64(1)

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches):
            winner = signatures(*_shingles(batch.column("text"), words), bands * rows)
            full = winner[:, 0] != 0
            keys = mix((mix(winner) * salt).reshape(-1, bands, rows).sum(axis=2, dtype=np.uint64)).view(np.int64)
            begin = np.concatenate([[0], np.cumsum(np.where(full, bands, 0))])
            short = (mix(winner) & U64(0xFFFF)).astype(np.uint16)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("sha"), lists(keys[full].ravel(), begin, pa.int64()),
                pa.array([row.tobytes() for row in short], pa.binary()),
            ], ["doc_id", "sha", "bands", "registers"])

    return sign


def _alike(least: float):
    """Pairs whose registers agree in a share of `least` at least."""

    def alike(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                one, two = (np.frombuffer(flat(batch.column(c))[0], np.uint16).reshape(batch.num_rows, -1) for c in ("r_a", "r_b"))
                near = pa.array((one == two).mean(axis=1) >= least)
                yield pa.RecordBatch.from_arrays([batch.column("a").filter(near), batch.column("b").filter(near)], ["a", "b"])

    return alike


def probability_jaccard(x: np.ndarray, y: np.ndarray) -> float:
    """Exact probability Jaccard of two lists of shingle hashes, each counted as often as it stands there."""
    (hx, cx), (hy, cy) = np.unique(x, return_counts=True), np.unique(y, return_counts=True)
    _, ix, iy = np.intersect1d(hx, hy, assume_unique=True, return_indices=True)
    if not len(ix):
        return 0.0
    only_x, only_y = cx.sum() - cx[ix].sum(), cy.sum() - cy[iy].sum()
    cx, cy = cx[ix].astype(float), cy[iy].astype(float)
    ratio, group = np.unique(cx / cy, return_inverse=True)
    sx, sy = np.bincount(group, cx), np.bincount(group, cy)
    above = only_x + np.cumsum(sx[::-1])[::-1]
    below = only_y + np.concatenate([[0.0], np.cumsum(sy)[:-1]])
    return float((sx / (above + ratio * below)).sum())


def _verifier(words: int, least: float):
    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            (one, a), (two, b) = (_shingles(batch.column(c), words) for c in ("text", "text_b"))
            similar = np.array([probability_jaccard(one[a[i] : a[i + 1]], two[b[i] : b[i + 1]]) for i in range(batch.num_rows)])
            good = np.flatnonzero(similar >= least - 1e-12)
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").take(pa.array(good)), batch.column("b").take(pa.array(good)), pa.array(similar[good])],
                ["a", "b", "similarity"])

    return verify


def _buckets(signed: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """All pairs (a < b) of small buckets, and rows (id, key, reach) of large ones; reach: members of all buckets of the id."""
    rows = signed.select("id", F.explode("bands").alias("key"))
    sized = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = scratch.store(rows.join(sized, "key"), "shared")
    small = shared.where(F.col("n") <= SMALL).select("id", "key")
    pairs = small.join(small.select(F.col("id").alias("b"), F.col("key").alias("b_key")), (F.col("key") == F.col("b_key")) & (F.col("id") < F.col("b")))
    reach = shared.groupBy("id").agg(F.sum("n").alias("reach"))
    return pairs.select(F.col("id").alias("a"), "b").distinct(), shared.where(F.col("n") > SMALL).join(reach, "id").select("id", "key", "reach")


def _classed(rows: DataFrame, found: DataFrame | None) -> DataFrame:
    if found is None:
        return rows.withColumn("class", F.col("id"))
    return rows.join(found, "id", "left").withColumn("class", F.coalesce("component", "id")).drop("component")


def _joined(found: DataFrame | None, more: DataFrame, scratch: Scratch) -> DataFrame:
    """Components (id, component) of `found` after the links `more` between its classes."""
    edges = more.select("a", "b")
    if found is not None:
        for end in ("a", "b"):
            edges = edges.join(found.select(F.col("id").alias(end), "component"), end, "left").withColumn(end, F.coalesce("component", end)).drop("component")
    united = components(edges, scratch)
    if found is None:
        return united
    known = found.join(united.select(F.col("id").alias("component"), F.col("component").alias("least")), "component", "left").select(
        "id", F.coalesce("least", "component").alias("component"))
    return scratch.store(known.union(united.join(found, "id", "left_anti")), "joined")


def _stars(large: DataFrame, used: DataFrame | None, found: DataFrame | None, scratch: Scratch, turn: int) -> tuple[DataFrame, DataFrame]:
    """Next centre (key, id) of each bucket that holds a class without one, and its pairs with members of other classes."""
    classed = large.withColumn("class", F.col("id")) if found is None else scratch.store(_classed(large, found), f"classed-{turn}")
    free = classed
    if used is not None:
        centred = _classed(used, found).select(F.col("key").alias("u_key"), F.col("class").alias("u_class")).distinct()
        free = classed.join(centred.hint("merge"), (F.col("key") == F.col("u_key")) & (F.col("class") == F.col("u_class")), "left_anti")
    best = free.groupBy("key").agg(F.max(F.struct("reach", (-F.col("id")).alias("least"), "class")).alias("c")).select(
        F.col("key").alias("c_key"), (-F.col("c.least")).alias("centre"), F.col("c.class").alias("c_class"))
    best = scratch.store(best, f"centres-{turn}")
    met = classed.join(best.hint("merge"), (F.col("key") == F.col("c_key")) & (F.col("class") != F.col("c_class"))).select(
        F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b")).distinct()
    return best.select(F.col("c_key").alias("key"), F.col("centre").alias("id")), met


def _verified(pairs: DataFrame, single: DataFrame, texts: DataFrame, scratch: Scratch, name: str, words: int, similarity: float,
              compared: bool = False) -> DataFrame:
    """Those of the pairs (a, b) whose similarity is `similarity` at least: a, b, similarity.

    Registers are held against each other before texts, unless sketches of the pairs have been `compared`.
    """
    near = pairs
    if not compared:
        ends = pairs.select(F.col("a").alias("x_id")).union(pairs.select("b"))
        registers = scratch.store(single.select(F.col("id").alias("x_id"), "registers").join(ends, "x_id", "left_semi"), f"{name}-registers")
        near = scratch.store(
            pairs.join(registers, F.col("a") == F.col("x_id")).select("a", "b", F.col("registers").alias("r_a"))
            .join(registers, F.col("b") == F.col("x_id")).select("a", "b", "r_a", F.col("registers").alias("r_b"))
            .mapInArrow(_alike(similarity - SLACK), "a long, b long"), f"{name}-near")
        scratch.drop(f"{name}-registers")
    bodies = scratch.store(_bodies(near.select(F.col("a").alias("id")).union(near.select("b")).distinct(), single, texts), f"{name}-bodies")
    links = (
        near.join(bodies, F.col("a") == F.col("doc_id")).select("a", "b", "text")
        .join(bodies.select(F.col("doc_id"), F.col("text").alias("text_b")), F.col("b") == F.col("doc_id"))
        .select("a", "b", "text", "text_b").mapInArrow(_verifier(words, similarity), "a long, b long, similarity double")
    )
    links = scratch.store(links, name)
    scratch.drop(f"{name}-near", f"{name}-bodies")
    return links


def _bodies(ids: DataFrame, single: DataFrame, texts: DataFrame) -> DataFrame:
    """Each text (doc_id, t_sha, text) of the members `ids`, once."""
    wanted = ids.join(single.select("id", "sha"), "id")
    return texts.select("doc_id", digest(F.col("text")).alias("t_sha"), "text").join(
        wanted, (F.col("doc_id") == F.col("id")) & (F.col("t_sha") == F.col("sha")), "left_semi").groupBy("doc_id", "t_sha").agg(
        F.first("text").alias("text"))


def _exploder(words: int):
    """One row per distinct shingle of each text, with its count and that of all."""

    def explode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches):
            hashes, begin = _shingles(batch.column("text"), words)
            doc, element, count = _weighted(hashes, begin)
            at = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(at), batch.column("tag").take(at), batch.column("class").take(at),
                 pa.array(np.diff(begin)[doc].astype(np.int64)), pa.array(element.view(np.int64)), pa.array(count.astype(np.int64))],
                ["id", "tag", "class", "total", "shingle", "n"])

    return explode


def _sketcher(words: int):
    """One bit of each of many registers per text: of two texts a share of (1 + similarity) / 2 agrees."""

    def sketch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches):
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                winner = signatures(*_shingles(part.column("text"), words), SKETCH * 64)
                bits = np.packbits((mix(winner ^ _STEP) & U64(1)).astype(bool), axis=1).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("tag"), *[pa.array(bits[:, i]) for i in range(SKETCH)]],
                    ["s_id", "s_tag", *[f"b{i}" for i in range(SKETCH)]])

    return sketch


def _left_open(rest: DataFrame, found: DataFrame, single: DataFrame, texts: DataFrame, scratch: Scratch, words: int,
               similarity: float) -> DataFrame | None:
    """Pairs (a < b) of open texts of different classes, among them all that are similar; None if no text is open."""
    classed = scratch.store(_classed(rest, found), "rest-classed")
    mixed = classed.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low < high").select("key")
    mixed = scratch.store(mixed, "rest-mixed")
    members = scratch.store(classed.join(mixed.hint("merge"), "key").select("id", "class").distinct(), "open")
    scratch.drop("rest-classed", "rest-mixed")
    if members.isEmpty():
        return None
    bodies = _bodies(members.select("id"), single, texts).join(members, F.col("doc_id") == F.col("id"))
    tagged = scratch.store(bodies.select("id", F.xxhash64("t_sha").alias("tag"), "class", "text"), "open-texts")
    shingles = scratch.store(tagged.mapInArrow(_exploder(words), "id long, tag long, class long, total long, shingle long, n long"), "shingles")
    bits = [f"b{i}" for i in range(SKETCH)]
    sketches = scratch.store(tagged.mapInArrow(_sketcher(words), "s_id long, s_tag long, " + ", ".join(f"{b} long" for b in bits)), "sketches")
    groups = shingles.groupBy("shingle", "class").agg(F.count(F.lit(1)).alias("m")).groupBy("shingle").agg(
        F.sum("m").alias("texts"), F.max_by("class", F.struct("m", "class")).alias("most"), F.count(F.lit(1)).alias("classes")).where("texts > 1")
    groups = scratch.store(groups, "groups")
    # A shingle of one text alone comes before all others and meets nothing, so only its weight counts.
    inside = Window.partitionBy("id", "tag")
    before = F.sum("n").over(inside.orderBy("texts", "shingle").rowsBetween(Window.unboundedPreceding, -1))
    alone = F.col("total") - F.sum("n").over(inside)
    share = (alone + F.coalesce(before, F.lit(0))) / F.col("total")
    odds = 1 / similarity - 1
    rows = shingles.join(groups.hint("merge"), "shingle").withColumn("share", share).where("classes > 1").where(
        F.col("share") <= 1 - similarity + 1e-9).select(
        "id", "tag", "class", "shingle", (F.col("share") / (1 - F.col("share"))).alias("odds"), (F.col("class") != F.col("most")).alias("minor"),
        F.least(F.ceil(F.col("texts") / SALT_TEXTS), F.lit(SALTS)).alias("salts"))
    rows = rows.join(sketches.hint("merge"), (F.col("id") == F.col("s_id")) & (F.col("tag") == F.col("s_tag"))).drop("tag", "s_id", "s_tag")
    rows = scratch.store(rows, "firsts")
    scratch.drop("shingles", "groups", "sketches", "open-texts")
    apart = (1 - similarity) / 2
    most = SKETCH * 64 * apart + DEVIATIONS * (SKETCH * 64 * apart * (1 - apart)) ** 0.5
    differ = sum((F.bit_count(F.col(b).bitwiseXOR(F.col(f"o_{b}"))) for b in bits), F.lit(0))

    def met(one: DataFrame, two: DataFrame) -> DataFrame:
        one = one.where(F.col("odds") <= odds / 2 + 1e-9).withColumn("salt", F.pmod(F.xxhash64("id"), F.col("salts")))
        two = two.select(F.col("id").alias("o_id"), F.col("class").alias("o_class"), F.col("shingle").alias("o_shingle"), F.col("odds").alias("o_odds"),
                         *[F.col(b).alias(f"o_{b}") for b in bits],
                         F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("o_salt"))
        return one.join(two.hint("merge"), (F.col("shingle") == F.col("o_shingle")) & (F.col("salt") == F.col("o_salt")) & (
            F.col("class") != F.col("o_class")) & (F.col("odds") + F.col("o_odds") <= odds + 1e-9) & (differ <= most)).select(F.least("id", "o_id").alias("a"), F.greatest("id", "o_id").alias("b"))

    pairs = met(rows.where("minor"), rows).union(met(rows.where("NOT minor"), rows.where("minor"))).distinct()
    pairs = scratch.store(pairs, "open-pairs")
    scratch.drop("firsts", "open")
    return pairs


def _linked(docs: DataFrame, scratch: Scratch, words: int, similarity: float, bands: int, rows: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Links, members (with sha) and components (id, component) of `near_links` and `near_classes`."""
    small_batches(docs.sparkSession)
    texts = long_ids(docs).select("doc_id", whole_text().alias("text")).where("doc_id IS NOT NULL")
    signed = scratch.store(
        texts.select("doc_id", digest(F.col("text")).alias("sha"), "text").mapInArrow(
            _signer(words, bands, rows), "doc_id long, sha binary, bands array<long>, registers binary"), "signed")
    # Stored, so that the join back can split a large group of copies.
    first = scratch.store(signed.groupBy("sha").agg(F.min("doc_id").alias("id")), "first")
    members = scratch.store(signed.select("doc_id", "sha").join(first, "sha").select("doc_id", "id", "sha"), "members")
    single = signed.join(first.select(F.col("id").alias("doc_id"), "sha"), ["doc_id", "sha"]).groupBy("doc_id", "sha").agg(
        F.first("bands").alias("bands"), F.first("registers").alias("registers"))
    single = scratch.store(single.select(F.col("doc_id").alias("id"), "sha", "bands", "registers"), "single")
    pairs, large = _buckets(single.where("size(bands) > 0"), scratch)
    large = scratch.store(large, "large")
    links = found = used = None
    for turn in range(CENTRES):
        centres, met = _stars(large, used, found, scratch, turn)
        # Pairs of small buckets don't wait for classes, nor do the first centres.
        met = scratch.store(met if turn else met.union(pairs).distinct(), f"met-{turn}")
        if not turn:
            scratch.drop("shared")
        used = centres if used is None else used.union(centres)
        more = _verified(met, single, texts, scratch, f"links-{turn}", words, similarity)
        if turn and more.isEmpty():
            break
        links = more if links is None else links.union(more)
        found = _joined(found, more, Scratch(docs.sparkSession, f"near-{turn}"))
    rest = large.select("id", "key").join(
        used.select(F.col("id").alias("u_id"), F.col("key").alias("u_key")).hint("merge"), (F.col("id") == F.col("u_id")) & (F.col("key") == F.col("u_key")), "left_anti")
    more = _left_open(rest, found, single, texts, scratch, words, similarity)
    if more is not None:
        late = _verified(more, single, texts, scratch, "late-links", words, similarity, compared=True)
        links = links.union(late)
        found = _joined(found, late, Scratch(docs.sparkSession, "near-late"))
        scratch.drop("open-pairs")
    scratch.drop("large", "single", *[f"{name}-{turn}" for turn in range(CENTRES) for name in ("classed", "centres", "met")])
    return links, members, found


def near_links(docs: DataFrame, scratch: Scratch, *, words: int = WORDS, similarity: float = SIMILARITY,
               bands: int = BANDS, rows: int = ROWS) -> tuple[DataFrame, DataFrame]:
    """Links (a, b, similarity) between representatives of different texts, and members (doc_id, id: representative).

    The representative of equal texts is the least doc_id.
    """
    return _linked(docs, scratch, words, similarity, bands, rows)[:2]


def near_classes(docs: DataFrame, *, words: int = WORDS, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per row of `docs` that has a doc_id: doc_id, copy_of (least doc_id of equal texts), class_id.

    A class holds what is joined by links of the given similarity; its id is its least doc_id.
    """
    _, members, found = _linked(docs, Scratch(docs.sparkSession, "near"), words, similarity, bands, rows)
    return members.join(found, "id", "left").select(
        "doc_id", F.col("id").alias("copy_of"), F.coalesce("component", "id").alias("class_id"), "sha")


def drop_near(docs: DataFrame, **how) -> DataFrame:
    """`docs` with one row of each class, that of its least doc_id; rows without doc_id stay."""
    stay = near_classes(docs, **how).where("doc_id = class_id").select("doc_id", F.col("sha").alias("text_digest"))
    kept = keep_rows(docs.where("doc_id IS NOT NULL"), stay, once=True)
    return kept.unionByName(docs.where("doc_id IS NULL"))
