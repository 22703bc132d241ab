"""Best-fit packing by a grouping genetic algorithm on islands.

An individual is a packing as groups of equal bins (see ``packing``). Crossover takes whole
well-filled bins of one parent into the other, drops the bins of the other that hold the
same pieces, and places what those bins held besides: first in exchange for one or two pieces of a
bin that they fill better, so that smaller pieces are left over, then by best fit. Each island
evolves its own individuals in a task; between rounds each sends its best to the next island.

No packing needs fewer bins than the tokens fill, so islands stop there.
"""

from __future__ import annotations

import json
import random
from bisect import bisect_right
from collections import Counter
from itertools import combinations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import stored
from ledgerline.llm.packing import Group, best_fit, bins_of, histogram, length_counts, placed
from ledgerline.llm.tokens import pieces

ISLANDS = 6
POPULATION = 8
GENERATIONS = 24
ROUNDS = 3
EXCHANGED = 128  # groups of bins that are tried for exchanges in one step
SCHEMA = "island int, bins bigint, waste double, genome string"


def least_bins(counts: dict[int, int], limit: int) -> int:
    """Bins that the tokens fill; no packing has fewer. Pieces over half a bin need one each."""
    total = sum(n * c for n, c in counts.items())
    return max(-(-total // limit), sum(c for n, c in counts.items() if 2 * n > limit))


def fitness(groups: list[Group], limit: int) -> tuple[int, float]:
    """Bins, then how evenly they are filled: of two packings the one with fuller bins is less."""
    return bins_of(groups), -sum(g.count * (sum(g.lengths) / limit) ** 2 for g in groups)


def merged(groups: list[Group]) -> list[Group]:
    """Groups with the same lengths as one, in a fixed order."""
    counts: Counter[tuple[int, ...]] = Counter()
    for g in groups:
        counts[tuple(sorted(g.lengths, reverse=True))] += g.count
    return [Group(lengths, n) for lengths, n in sorted(counts.items()) if n]


def exchange(lengths: tuple[int, ...], free: int, loose: list[int]) -> tuple[tuple[int, ...], tuple[int, ...]] | None:
    """(out, in): at most two pieces of a bin and one or two of the ascending ``loose`` lengths
    that fill more of it, as much as any such exchange; none if nothing fills more."""
    best, gain = None, 0
    outs = {(), *((n,) for n in lengths), *combinations(sorted(lengths), 2)}
    for out in sorted(outs):
        least, room = sum(out), sum(out) + free
        at = bisect_right(loose, room) - 1
        if at >= 0 and loose[at] - least > gain:
            best, gain = (out, (loose[at],)), loose[at] - least
        low, high = 0, at
        while low < high:  # two different lengths whose sum comes closest to the room
            both = loose[low] + loose[high]
            if both > room:
                high -= 1
                continue
            if both - least > gain:
                best, gain = (out, (loose[low], loose[high])), both - least
            low += 1
        if gain == free:
            break
    return best


def exchanged(groups: list[Group], displaced: Counter, limit: int, rng: random.Random, most: int = EXCHANGED) -> tuple[list[Group], Counter]:
    """The groups and displaced pieces after exchanges in groups with room, if many in some of them."""
    roomy = [g for g in groups if sum(g.lengths) < limit]
    rng.shuffle(roomy)
    left, found = Counter(displaced), [*roomy[most:], *[g for g in groups if sum(g.lengths) == limit]]
    for group in roomy[:most]:
        count = group.count
        while count:
            free = limit - sum(group.lengths)
            swap = exchange(group.lengths, free, sorted(n for n, k in left.items() if k > 0))
            if swap is None:
                break
            out, into = Counter(swap[0]), Counter(swap[1])
            times = min(count, *(left[n] // k for n, k in into.items()))
            kept = Counter(group.lengths) - out + into
            found.append(Group(tuple(sorted(kept.elements(), reverse=True)), times))
            for n, k in out.items():
                left[n] += k * times
            for n, k in into.items():
                left[n] -= k * times
            count -= times
        if count:
            found.append(Group(group.lengths, count))
    return found, +left


def crossover(mother: list[Group], father: list[Group], limit: int, rng: random.Random) -> list[Group]:
    """The mother's packing with some of the father's fullest bins in it."""
    ranked = sorted(father, key=lambda g: (-sum(g.lengths), rng.random()))
    share = rng.uniform(0.05, 0.6) * bins_of(father)
    injected, taken = [], 0
    for group in ranked:
        if taken >= share:
            break
        if rng.random() < 0.7:
            count = min(group.count, max(int(share - taken), 1))
            injected.append(Group(group.lengths, count))
            taken += count
    doubled: Counter[int] = Counter()
    for group in injected:
        for length in group.lengths:
            doubled[length] += group.count
    kept, displaced = [], Counter()
    for group in sorted(mother, key=lambda g: (sum(g.lengths), rng.random())):  # loose bins go first
        content = Counter(group.lengths)
        needed = min(group.count, max((-(-doubled[n] // k) for n, k in content.items() if doubled[n] > 0), default=0))
        for length, k in content.items():
            gone = min(doubled[length], k * needed)
            doubled[length] -= gone
            displaced[length] += k * needed - gone
        kept.append(Group(group.lengths, group.count - needed))
    placed_groups, left = exchanged([*injected, *[g for g in kept if g.count]], +displaced, limit, rng)
    return merged(best_fit(left, limit, placed_groups))


def mutated(groups: list[Group], limit: int, rng: random.Random) -> list[Group]:
    """The emptiest, some other loose and some random bins are emptied and their pieces placed anew."""
    ranked = sorted(groups, key=lambda g: (sum(g.lengths), rng.random()))
    loose = max(sum(sum(g.lengths) < limit for g in ranked) // 4, 1)
    picked = {0, *(rng.randrange(loose) for _ in range(rng.randint(1, 3))), *(rng.randrange(len(ranked)) for _ in range(rng.randint(0, 3)))}
    emptied, kept = Counter(), []
    for i, group in enumerate(ranked):
        gone = int(i in picked)
        for length in group.lengths:
            emptied[length] += gone
        kept.append(Group(group.lengths, group.count - gone))
    placed_groups, left = exchanged([g for g in kept if g.count], +emptied, limit, rng)
    order = sorted(left, key=lambda n: -n * rng.uniform(0.6, 1.4))
    return merged(best_fit(left, limit, placed_groups, order))


def founder(counts: dict[int, int], limit: int, rng: random.Random, exact: bool) -> list[Group]:
    """Best fit decreasing, or best fit in a disturbed order."""
    order = sorted(counts, key=lambda n: -n * (1 if exact else rng.uniform(0.7, 1.3)))
    return merged(best_fit(counts, limit, order=order))


def evolve(population: list[list[Group]], limit: int, rng: random.Random, generations: int, stop_at: int,
           size: int = POPULATION) -> list[list[Group]]:
    """The island's individuals after some generations, best first."""
    def rank(found):
        different = {tuple(sorted((g.lengths, g.count) for g in groups)): groups for groups in found}
        return sorted(different.values(), key=lambda g: fitness(g, limit))[:size]

    population = rank(population)
    for _ in range(generations):
        if bins_of(population[0]) <= stop_at:
            break
        children = []
        for _ in range(size):
            mother, father = (min(rng.sample(population, min(2, len(population))), key=lambda g: fitness(g, limit)) for _ in range(2))
            child = crossover(mother, father, limit, rng)
            children.append(mutated(child, limit, rng) if rng.random() < 0.5 else child)
        population = rank([*population, *children])
    return population


def dump(groups: list[Group]) -> str:
    return json.dumps([[list(g.lengths), g.count] for g in groups])


def load(genome: str) -> list[Group]:
    return [Group(tuple(lengths), count) for lengths, count in json.loads(genome)]


def pack(spark: SparkSession, counts: dict[int, int], limit: int, islands: int = ISLANDS, rounds: int = ROUNDS,
         generations: int = GENERATIONS, seed: int = 17) -> list[Group]:
    """The best packing of a length histogram that the islands find."""
    stop_at = least_bins(counts, limit)

    def rows(island: int, population: list[list[Group]]) -> pd.DataFrame:
        scored = [(island, *fitness(g, limit), dump(g)) for g in population]
        return pd.DataFrame(scored, columns=["island", "bins", "waste", "genome"])

    def settle(part: pd.DataFrame) -> pd.DataFrame:
        island = int(part["id"].iloc[0])
        rng = random.Random(f"{seed}:{island}")
        return rows(island, [founder(counts, limit, rng, exact=i == 0) for i in range(POPULATION)])

    def next_round(number: int):
        def run(part: pd.DataFrame) -> pd.DataFrame:
            island = int(part["island"].iloc[0])
            genomes = sorted(set(part["genome"]))
            rng = random.Random(f"{seed}:{island}:{number}")
            return rows(island, evolve([load(g) for g in genomes], limit, rng, generations, stop_at))
        return run

    # A fixed number of partitions: sized by these few rows, islands would share one task.
    tasks = 4 * islands
    founded = spark.range(islands).repartition(tasks, "id").groupBy("id").applyInPandas(settle, SCHEMA)
    population = stored(founded, "island-population")
    best = population.orderBy("bins", "waste", "genome").first()
    for number in range(rounds):
        if best["bins"] <= stop_at:
            break
        elites = population.groupBy("island").agg(F.min(F.struct("bins", "waste", "genome")).alias("e")).select(
            ((F.col("island") + 1) % islands).cast("int").alias("island"), "e.bins", "e.waste", "e.genome"
        )
        moved = population.unionByName(elites).repartition(tasks, "island").groupBy("island").applyInPandas(next_round(number), SCHEMA)
        population = stored(moved, "island-population")
        best = population.orderBy("bins", "waste", "genome").first()
    return load(best["genome"])


def pack_documents(docs: DataFrame, limit: int = 1024, end: int = 2, ranks: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row per piece.

    Defined results: null and empty texts are the end id alone. Longer documents than a
    sequence are cut into full pieces but for the first. Documents without an id are packed
    with a null id, repeated rows each; no documents give no rows. Texts are read whole,
    other columns are not read.
    """
    cut = stored(pieces(docs, limit, end, ranks), "token-pieces")
    counts = length_counts(cut)
    lengths = histogram(counts)
    if not lengths:
        return cut.drop("part", "number").withColumn("sequence_id", F.lit(0).cast("bigint")).withColumn("offset", F.lit(0).cast("bigint"))
    return placed(cut, counts, pack(docs.sparkSession, lengths, limit))
