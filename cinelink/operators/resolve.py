"""Entity resolution: match, elect one master per entity, fill its fields.

Records are taken in priority order `pos`; a record matching an earlier master
follows it, any other record becomes a master. What a record is matched on never
changes, so the masters are the first maximal independent set of the match relation
in `pos` order, and can be found in rounds.

Records are never paired with each other. Every record belongs to up to three
hubs: its tmdb_id, its imdb_id and its title group (token-sorted title, year). All
members of a hub match one another, and so do the members of two similar title
groups; a hub holds at most one master. Rounds therefore work on one row per hub,
and a hub with a third of all records costs no more than its members.
"""

from functools import reduce

from pyspark.sql import functions as F

from cinelink import schema as S
from cinelink.functions import text
from cinelink.operators.dedup import uncovered_titles
from cinelink.operators.profile import counted
from cinelink.operators.similarity import Titles
from cinelink.runtime import hot_keys, lookup_join, materialize, new_path, skew_join, together

MAX_ROUNDS = 1000

# Larger edge tables are cut down to the undecided hubs whenever half of the records
# have been settled; smaller ones are cheaper to read again.
SHRINK_EDGES = 1_000_000


def title_hub(token_key, year):
    """Name of the hub of a title group; null for titles that match nothing."""
    return F.when(
        token_key != "", F.concat(F.lit("g"), F.coalesce(year.cast("string"), F.lit("-")), F.lit(":"), token_key)
    )


def match_nodes(records):
    """The columns matching needs, one row per record."""
    return records.select(
        "pos", "tmdb_id", "imdb_id", "title_norm", "year",
        text.token_key(F.col("title_norm")).alias("token_key"),
    )


def memberships(nodes):
    """One row per record and hub: (hub, pos, hubs), `hubs` counting the record's hubs."""
    names = F.array_compact(F.array(
        F.concat(F.lit("t"), F.col("tmdb_id").cast("string")),
        F.concat(F.lit("i"), F.col("imdb_id")),
        title_hub(F.col("token_key"), F.col("year")),
    ))
    return nodes.select("pos", names.alias("names")).select(
        F.explode("names").alias("hub"), "pos", F.size("names").alias("hubs")
    )


def title_groups(nodes):
    return nodes.where("token_key <> ''").select("token_key", "year").distinct()


def edges_of(pairs):
    """Similar title groups in both directions: (hub_a, hub_b, score)."""
    pairs = pairs.select(
        title_hub(F.col("s_a"), F.col("y_a")).alias("hub_a"),
        title_hub(F.col("s_b"), F.col("y_b")).alias("hub_b"),
        "score",
    )
    both = F.explode(F.array(
        F.struct("hub_a", "hub_b"), F.struct(F.col("hub_b").alias("hub_a"), F.col("hub_a").alias("hub_b"))))
    return pairs.select(both.alias("e"), "score").select("e.hub_a", "e.hub_b", "score")


def same_id_links(records, id_column, hot_rows=None):
    """Each record to the earliest record with the same identifier; identifiers of more than `hot_rows` records are split."""
    first = records.where(F.col(id_column).isNotNull()).groupBy(id_column).agg(F.min("pos").alias("earlier"))
    later = records.where(F.col(id_column).isNotNull()).select(F.col("pos").alias("later"), id_column)
    hot = hot_keys(later, [id_column], hot_rows)
    links = skew_join(later, first, [id_column], "inner", hot, spread_by=["later"])
    return links.where("earlier < later")


def hub_leads(members):
    """The first record of each hub: (hub, lead), `lead` being (pos, hubs)."""
    return members.groupBy("hub").agg(F.min(F.struct("pos", "hubs")).alias("lead"))


def winners_of(leads):
    """Records that lead in all their hubs."""
    return (
        leads.groupBy("lead").agg(F.count(F.lit(1)).alias("n")).where("n = lead.hubs").select("lead.pos")
    )


def settle(members, hubs, hot):
    """The members left when everyone in `hubs` has been decided, and their number, counted by the write."""
    settled = skew_join(members, hubs.distinct(), ["hub"], "left_semi", hot, ["pos"])
    return counted(members.join(settled.select("pos").distinct(), "pos", "left_anti"), "open")[:2]


def elect_masters(members, edges, hot=None, max_rounds=MAX_ROUNDS, hot_rows=None):
    """Positions of the masters among the records of `members`.

    Both inputs must be stored tables. Each round settles every record that is the
    first undecided one in all its hubs and their neighbours; its whole
    neighbourhood follows and leaves. The rounds needed grow with the longest chain
    of records that depend on one another; exceeding `max_rounds` raises.
    """
    spark, table = members.sparkSession, new_path(members.sparkSession, "masters")
    n_edges, open_, left = edges.count(), members, members.count()
    if not left:
        return members.select("pos").limit(0)
    at_last_cut, many = left, n_edges > SHRINK_EDGES
    hot_edges = hot_keys(edges, ["hub_b"], hot_rows, at_most=n_edges)
    # Edges go both ways, so hubs are as hot on one side as on the other.
    hot_back = None if hot_edges is None else hot_edges.withColumnRenamed("hub_b", "hub_a")
    rounds = 0
    while left and rounds < max_rounds:
        # The first undecided record of each hub, unless a similar hub has an earlier one.
        lead = hub_leads(open_)
        beside = (
            skew_join(edges, lead.withColumnRenamed("hub", "hub_b"), ["hub_b"], "inner", hot_edges, ["hub_a"])
            .groupBy(F.col("hub_a").alias("hub")).agg(F.min("lead.pos").alias("beside"))
        )
        leads = lead.join(beside, "hub", "left").where("beside is null or lead.pos < beside")
        # One table takes the winners of all rounds, a folder for each.
        winners_of(leads).write.parquet(f"{table}/round={rounds}")
        winners = spark.read.schema(members.select("pos").schema).parquet(f"{table}/round={rounds}")
        # Hubs with a master now, similar hubs included, settle all their members.
        won = open_.join(winners, "pos", "left_semi").select("hub").distinct()
        near = skew_join(edges, won.withColumnRenamed("hub", "hub_a"), ["hub_a"], "left_semi", hot_back, ["hub_b"]).select("hub_b")
        open_, left = settle(open_, won.union(near), hot)
        rounds += 1
        if many and left and left * 2 <= at_last_cut:
            edges = materialize(among_hubs(edges, open_), "edges")
            at_last_cut, many = left, edges.count() > SHRINK_EDGES
    if left:
        raise RuntimeError(f"masters not settled after {max_rounds} rounds; raise max_rounds")
    return spark.read.schema(members.select("pos").schema).parquet(*[f"{table}/round={i}" for i in range(rounds)])


def among_hubs(edges, members):
    """Edges between hubs that still have members."""
    hubs = members.select("hub").distinct()
    for side in ("hub_a", "hub_b"):
        edges = edges.join(hubs.withColumnRenamed("hub", side), side, "left_semi")
    return edges.select("hub_a", "hub_b", "score")


def absorb_crowds(members, nodes, titles, grid, hot):
    """Masters found without comparing titles pairwise, and the members left over.

    For crowded blocks, where the pairs may be too many to list. A record that leads
    its hubs and comes first under all block keys of its title is a master for
    certain; only the titles of such masters are compared with the rest, which
    removes crowds of near copies at a cost that grows with their number. Stops when
    a round settles less than a tenth of what was left.
    """
    found, open_, left = [], members, members.count()
    hubs = nodes.select(title_hub(F.col("token_key"), F.col("year")).alias("hub"), "token_key", "year").where(
        "hub is not null").distinct()
    hubs = materialize(hubs, "title-hubs")
    while left:
        lead = hub_leads(open_)
        named = lead.join(hubs, "hub").select("hub", "token_key", "year", F.col("lead.pos").alias("lead"))
        first = titles.first_in_blocks(named).select(title_hub(F.col("token_key"), F.col("year")).alias("hub"))
        others = lead.where("not startswith(hub, 'g')")
        winners = materialize(winners_of(others.union(lead.join(first, "hub", "left_semi"))), "masters")
        won = open_.join(winners, "pos", "left_semi").select("hub")
        chosen = titles.subset(hubs.join(won, "hub", "left_semi"))
        near = edges_of(titles.pairs(grid, chosen)).join(
            won.withColumnRenamed("hub", "hub_a"), "hub_a", "left_semi").select("hub_b")
        found.append(winners)
        before = left
        open_, left = settle(open_, won.union(near), hot)
        if left * 10 > before * 9:
            break
    return found, open_


def assign_masters(members, edges, masters, hot=None, hot_rows=None):
    """Each follower's master: same tmdb_id, else same imdb_id, else the most similar title.

    Only masters before the follower count; equal scores go to the earliest master.
    Returns (pos, master, level, score).
    """
    held = members.join(masters, "pos", "left_semi").select("hub", F.col("pos").alias("master"))
    kind = F.substring("hub", 1, 1)
    own = held.select(
        "hub",
        F.when(kind == "t", 1).when(kind == "i", 2).otherwise(3).alias("level"),
        F.when(kind == "g", -100.0).otherwise(F.lit(0.0)).alias("rank"),
        "master",
    )
    hot_edges = hot_keys(edges, ["hub_b"], hot_rows, at_most=edges.count())
    beside = skew_join(edges, held.withColumnRenamed("hub", "hub_b"), ["hub_b"], "inner", hot_edges, ["hub_a"]).select(
        F.col("hub_a").alias("hub"), F.lit(3).alias("level"), (-F.col("score")).alias("rank"), "master"
    )
    # Per hub and score only the earliest master can win, so the list kept per hub is
    # as short as the number of different scores two titles of its length can have.
    offers = (
        own.union(beside).groupBy("hub", "level", "rank").agg(F.min("master").alias("master"))
        .groupBy("hub").agg(F.collect_list(F.struct("level", "rank", "master")).alias("offers"))
    )
    followers = members.join(masters, "pos", "left_anti")
    asked = skew_join(followers, offers, ["hub"], "inner", hot, spread_by=["pos"])
    best = F.array_min(F.filter("offers", lambda o: o["master"] < F.col("pos")))
    chosen = asked.select("pos", best.alias("best")).groupBy("pos").agg(F.min("best").alias("best"))
    return chosen.select(
        "pos", F.col("best.master").alias("master"), F.col("best.level").alias("level"),
        F.when(F.col("best.level") == 3, -F.col("best.rank")).alias("score"),
    )


def fill_fields(assigned):
    """One row per master: its own values, gaps filled by the first follower in `pos` order.

    `assigned` holds every record with its `master`. Adds `sources`, the
    contributors in priority order, and keeps the identifiers the master was
    registered with as `registered_tmdb` and `registered_imdb`.
    """
    is_master = F.col("pos") == F.col("master")
    # A master comes first, also before followers of a higher priority (`strict_ids`).
    order = F.struct((~is_master).alias("follows"), "pos")

    def first(name, allowed):
        return F.min_by(name, F.when(F.col(name).isNotNull() & allowed, order)).alias(name)

    fields = [first(c, F.lit(True)) for c in S.FILL_FROM_ANY]
    fields += [first(c, is_master | (F.col("source") == s)) for c, s in S.FILL_FROM_SOURCE.items()]
    fields += [first(c, is_master) for c in S.MASTER_ONLY]
    fields += [
        F.min_by("tmdb_id", F.when(is_master, F.col("pos"))).alias("registered_tmdb"),
        F.min_by("imdb_id", F.when(is_master, F.col("pos"))).alias("registered_imdb"),
        # A set of labels stays as small as the number of sources.
        F.collect_set(F.struct(S.source_priority(F.col("source")).alias("p"), "source")).alias("by"),
    ]
    filled = assigned.groupBy(F.col("master").alias("pos")).agg(*fields)
    return filled.withColumns({
        "sources": F.transform(F.array_sort("by"), lambda b: b["source"]),
        "year": F.year("release_date"),
    }).drop("by")


def assemble(entities):
    """The gold rows among the filled masters.

    All masters registered with a tmdb_id; those registered with an imdb_id only,
    unless a tmdb master has acquired that imdb_id; of the rest the last one per
    (title_norm, year) not covered yet. `tier` tells the three apart.
    """
    by_tmdb = entities.where("registered_tmdb is not null")
    covered = by_tmdb.where("imdb_id is not null").select("imdb_id").distinct()
    by_imdb = entities.where("registered_tmdb is null and registered_imdb is not null").join(
        covered, "imdb_id", "left_anti").select(entities.columns)
    by_id = by_tmdb.withColumn("tier", F.lit(1)).union(by_imdb.withColumn("tier", F.lit(2)))
    # The last master of a key stands for it, whether or not it has identifiers.
    row = F.struct(*[c for c in entities.columns if c not in ("title_norm", "year")])
    last = entities.groupBy("title_norm", "year").agg(F.max_by(row, "pos").alias("row"))
    last = last.select(*[
        F.col(c) if c in ("title_norm", "year") else F.col(f"row.{c}").alias(c) for c in entities.columns
    ])
    by_title = uncovered_titles(last, by_id).withColumn("tier", F.lit(3))
    return by_id.union(by_title).drop("registered_tmdb", "registered_imdb")


def by_strict_ids(nodes, hot_rows=None):
    """(nodes, followers): of every tmdb_id the first record, which is a master, and its later records, which follow it.

    `pos` of the nodes left puts those masters before all records without a tmdb_id.
    """
    named = nodes.where("tmdb_id is not null")
    first = named.groupBy("tmdb_id").agg(F.min("pos").alias("master"))
    named = lookup_join(named, first, ["tmdb_id"], "inner", hot_rows)
    followers = named.where(F.col("pos") != F.col("master")).select(
        "pos", "master", F.lit(1).alias("level"), F.lit(None).cast("double").alias("score"))
    masters = named.where(F.col("pos") == F.col("master")).select(nodes.columns)
    left = masters.union(nodes.where("tmdb_id is null"))
    return left.withColumn("pos", F.struct(F.col("tmdb_id").isNull().alias("loose"), F.col("pos").alias("pos"))), followers


def link_records(records, threshold=None, max_rounds=MAX_ROUNDS, hot_block=None, strict_ids=False, hot_rows=None):
    """Every record's master: (pos, master, level, score); masters have level 0.

    `hot_block`: titles under one block key that one task compares, see `Titles`.
    `strict_ids`: no entity holds two tmdb_ids. Then the first record of every tmdb_id is a
    master, whatever else it shares with others, the later ones follow it, and records
    without a tmdb_id are matched and elected after them, in their order.
    """
    nodes = materialize(match_nodes(records), "nodes")
    if not strict_ids:
        return _links(nodes, threshold, max_rounds, hot_block, hot_rows=hot_rows)
    nodes, followers = by_strict_ids(nodes, hot_rows)
    links = _links(materialize(nodes, "nodes"), threshold, max_rounds, hot_block, True, hot_rows)
    return links.select(F.col("pos.pos").alias("pos"), F.col("master.pos").alias("master"), "level", "score").union(followers)


def _links(nodes, threshold, max_rounds, hot_block, strict_ids=False, hot_rows=None):
    """`link_records` for stored nodes; with `strict_ids` those with a tmdb_id are masters already."""
    threshold = S.FUZZY_THRESHOLD if threshold is None else float(threshold)
    def similar():
        titles = Titles(title_groups(nodes), threshold, hot_block)
        grid = titles.crowded()
        # In crowds the pairs may be too many to list.
        return titles, grid, materialize(edges_of(titles.pairs()), "edges") if grid is None else None

    def joined():
        members, n, _ = counted(memberships(nodes), "members")
        return members, hot_keys(members, ["hub"], hot_rows, at_most=n)

    (titles, grid, edges), (members, hot) = together(similar, joined)
    given, open_ = [], members
    if strict_ids:
        # What matches a given master is settled before the election.
        given = [nodes.where("not pos.loose").select("pos")]
        won = members.join(given[0], "pos", "left_semi").select("hub").distinct()
        named = title_groups(nodes.join(given[0], "pos", "left_semi"))
        near = edges_of(titles.pairs(grid, titles.subset(named))).join(
            won.withColumnRenamed("hub", "hub_a"), "hub_a", "left_semi").select("hub_b")
        open_, _ = settle(members, won.union(near), hot)
    if grid is None:
        elected = elect_masters(open_, edges, hot, max_rounds, hot_rows)
        masters = materialize(reduce(lambda a, b: a.union(b), given, elected), "elected") if given else elected
    else:
        found, open_ = absorb_crowds(open_, nodes, titles, grid, hot)
        found += given
        rest = Titles(title_groups(nodes.join(open_.select("pos").distinct(), "pos", "left_semi")), threshold, hot_block)
        edges = materialize(edges_of(rest.pairs(grid=rest.crowded())), "edges")
        found.append(elect_masters(open_, edges, hot, max_rounds, hot_rows))
        masters = materialize(reduce(lambda a, b: a.union(b), found), "elected")
        # Followers choose among the masters only.
        held = title_groups(nodes.join(masters, "pos", "left_semi"))
        edges = materialize(edges_of(titles.pairs(grid, titles.subset(held))), "edges")
    followers = materialize(assign_masters(members, edges, masters, hot, hot_rows), "followers")
    # Records without any hub match nothing and are masters too.
    own = nodes.select("pos").join(followers.select("pos"), "pos", "left_anti")
    return own.select(
        "pos", F.col("pos").alias("master"), F.lit(0).alias("level"), F.lit(None).cast("double").alias("score")
    ).union(followers)


def resolve(records, threshold=None, max_rounds=MAX_ROUNDS, strict_ids=False):
    """De-duplicated records of all sources to gold entities.

    `records` needs the canonical columns plus `title_norm`, `year` and a unique
    `pos`, as `deduplicate` returns them.
    """
    links = link_records(records, threshold, max_rounds, strict_ids=strict_ids).select("pos", "master")
    entities = fill_fields(records.join(links, "pos"))
    return assemble(materialize(entities, "entities"))
