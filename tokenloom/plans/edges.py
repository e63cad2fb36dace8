"""Identity edges: two identifiers seen together, written in both directions.

All identifiers but those of devices hang on users. Orders, registrations and cards are therefore
reduced to statements "this user, in this app, at this time", and one join gives all of them their
identifiers. No pair is written out only to be merged again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.codes import VT_TYPES
from tokenloom.functions.text import blank_to_null, first_text, has_text
from tokenloom.functions.times import epoch_ms
from tokenloom.operators.latest import profile_latest
from tokenloom.operators.lookups import join_token
from tokenloom.operators.predicates import has_order_no
from tokenloom.plans.assemble import assemble_bankcard, user_identity
from tokenloom.settings import DEFAULT, Settings

# Kinds of identifier, in the order that decides between equal times.
EDGE_ORDER = ("bank_account", "device_uuid", "gaid_idfa", "id2", "id_number", "mobile")
_RANK = {name: rank for rank, name in enumerate(EDGE_ORDER)}
_RANK_BITS = 3

# Which identifiers of an application are linked.
APPLICATION_LINKS = (
    ("mobile", "gaid_idfa"),
    ("mobile", "bank_account"),
    ("mobile", "id_number"),
    ("mobile", "device_uuid"),
    ("device_uuid", "gaid_idfa"),
)


def _pair(a_kind: str, a: Column, b_kind: str, b: Column) -> Column:
    return F.struct(
        blank_to_null(a).alias("a"), F.lit(_RANK[a_kind]).alias("a_rank"),
        blank_to_null(b).alias("b"), F.lit(_RANK[b_kind]).alias("b_rank"),
    )


def _pairs(df: DataFrame, owner: Column, app: Column, time: Column, n: Column, *pairs: Column) -> DataFrame:
    """Linked identifiers of every row; those missing a side or linking a value to itself drop."""
    rows = df.select(owner.alias("owner"), app.cast("int").alias("app_id"), time.alias("t"), n.alias("n"), F.explode(F.array(*pairs)).alias("p"))
    return rows.select("owner", "app_id", "t", "n", "p.*").filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")


def user_owner(user_id: Column) -> Column:
    """The name under which a user's own statements are kept."""
    return F.concat(F.lit("user:"), user_id.cast("string"))


def device_owner(device_uuid: Column) -> Column:
    return F.concat(F.lit("device:"), device_uuid)


def _reduced(df: DataFrame, keys: list[str], time: str, every_time: bool) -> DataFrame:
    count = F.count(F.lit(1)).alias("n")
    if every_time:
        return df.groupBy(*keys, F.col(time).alias("at")).agg(count)
    return df.groupBy(*keys).agg(F.max(time).alias("at"), count)


def linked_pairs(sources, settings: Settings = DEFAULT, every_time: bool = False) -> DataFrame:
    """Undirected pairs (owner, a, b, app_id, t) with ``n``, the number of source rows that state them.

    With ``every_time`` orders and devices keep each of their times, else only the latest, which is
    all the keyed output needs.
    """
    return user_pairs(sources, settings, every_time).unionByName(device_pairs(sources, settings, every_time))


def user_pairs(
    sources, settings: Settings = DEFAULT, every_time: bool = False, stated_by: tuple[str, ...] = ("order", "user", "card")
) -> DataFrame:
    """What the users state with their orders, registrations and cards, or with some of these."""
    one, dictionary = F.lit(1).cast("bigint"), sources["vt_token_cache"]
    stated = ["user_id", "app_code", "at", "n", "source", "card_token"]
    orders = _reduced(sources["user_order"].filter(has_order_no()), ["user_id", "app_code"], "order_time", every_time)
    orders = orders.withColumns({"source": F.lit("order"), "card_token": F.lit(None).cast("string")})
    people = sources["user"].select(F.col("id").alias("user_id"), "app_code", "create_time", "update_time")
    users = people.withColumns(
        {"at": F.col("create_time"), "n": one, "source": F.lit("user"), "card_token": F.lit(None).cast("string")}
    )
    cards = assemble_bankcard(sources).filter(has_text("bank_account_token"))
    cards = cards.groupBy("user_id", F.col("bank_account_token").alias("card_token")).agg(F.count(one).alias("n"))
    cards = people.join(cards, "user_id", "inner").withColumns({"at": F.col("update_time"), "source": F.lit("card")})
    kinds = {"order": orders, "user": users, "card": cards}
    statements = reduce(DataFrame.unionByName, [kinds[kind].select(*stated) for kind in stated_by])

    profile = profile_latest(sources["user_personal_info"]).select("user_id", F.trim("bvn").alias("latest_bvn"))
    profile = join_token(profile.filter(has_text("latest_bvn")), dictionary, VT_TYPES["id_number"], "latest_bvn", "latest_id_token", "user_id")
    identity = user_identity(sources).join(profile, "user_id", "left")

    def of(source: str, column: str) -> Column:
        return F.when(F.col("source") == source, F.col(column))

    held = {
        "mobile": "mobile_token",
        "gaid_idfa": "gaid_idfa_token",
        "bank_account": "bank_account_token",
        "id_number": "id_number_token",
        "device_uuid": "device_uuid",
    }
    return _pairs(
        statements.join(identity, "user_id", "inner"),
        user_owner(F.col("user_id")), F.col("app_code"), epoch_ms("at", settings.zone), F.col("n"),
        *[_pair(x, of("order", held[x]), y, F.col(held[y])) for x, y in APPLICATION_LINKS],
        _pair("mobile", of("user", "mobile_token"), "device_uuid", F.col("device_uuid")),
        _pair("mobile", of("user", "mobile_token"), "id_number", F.col("latest_id_token")),
        _pair("mobile", of("card", "mobile_token"), "bank_account", F.col("card_token")),
    )


def device_pairs(sources, settings: Settings = DEFAULT, every_time: bool = False) -> DataFrame:
    """What devices state: their advertising ids, in the apps of the users who hold them."""
    devices = sources["device_ids"].filter(has_text("device_uuid")).select(
        "device_uuid", first_text("aaid", "idfa").alias("ad_id"), F.coalesce("update_time", "create_time").alias("seen")
    )
    devices = _reduced(devices.filter("ad_id IS NOT NULL"), ["device_uuid", "ad_id"], "seen", every_time).withColumnRenamed("n", "devices")
    devices = join_token(devices, sources["vt_token_cache"], VT_TYPES["gaid_idfa"], "ad_id", "ad_token", "device_uuid")
    owners = sources["user"].filter(has_text("device_id")).groupBy(F.col("device_id").alias("device_uuid"), "app_code")
    owners = owners.agg(F.count(F.lit(1)).alias("users"))
    return _pairs(
        devices.filter(has_text("ad_token")).join(owners, "device_uuid", "inner"),
        device_owner(F.col("device_uuid")), F.col("app_code"), epoch_ms("at", settings.zone), F.col("devices") * F.col("users"),
        _pair("device_uuid", F.col("device_uuid"), "gaid_idfa", F.col("ad_token")),
    )


def _type(rank: Column) -> Column:
    return F.element_at(F.array(*[F.lit(name) for name in EDGE_ORDER]), rank.cast("int") + 1)


def _directions(first: Column, second: Column) -> Column:
    return F.explode(F.array(first, second)).alias("edge")


def edge_rows(sources, settings: Settings = DEFAULT) -> DataFrame:
    """Every directed edge as stated by the source rows, equal ones counted in ``n``."""
    return stated_edges(linked_pairs(sources, settings, every_time=True))


def stated_edges(pairs: DataFrame) -> DataFrame:
    """Both directions of pairs that keep all their times."""

    def end(x: str, y: str) -> Column:
        return F.struct(F.col(x).alias("id"), F.col(y).alias("mapping_id"), F.col(f"{x}_rank").alias("rank"))

    rows = pairs.select("app_id", "t", "n", _directions(end("a", "b"), end("b", "a")))
    keys = [F.col("edge.id"), F.col("app_id"), F.col("edge.mapping_id"), F.col("edge.rank"), F.col("t")]
    counted = rows.groupBy(*keys).agg(F.sum("n").alias("n"))
    return counted.select("id", "app_id", "mapping_id", _type(F.col("rank")).alias("type"), F.col("t").alias("event_time"), "n")


def _undirected(pairs: DataFrame) -> DataFrame:
    """Pairs with their ends in order. Time and type rank are packed into one number, so the winner is a plain maximum."""
    swapped = F.col("a") > F.col("b")

    def ordered(if_swapped: str, otherwise: str) -> Column:
        return F.when(swapped, F.col(if_swapped)).otherwise(F.col(otherwise))

    packed = F.shiftleft("t", _RANK_BITS)
    return pairs.select(
        "owner", "n", ordered("b", "a").alias("low"), ordered("a", "b").alias("high"), "app_id",
        packed.bitwiseOR(ordered("b_rank", "a_rank").cast("bigint")).alias("low_best"),
        packed.bitwiseOR(ordered("a_rank", "b_rank").cast("bigint")).alias("high_best"),
    )


_BEST = (F.max, "low_best"), (F.max, "high_best")
#: What tells one owner's part in a pair from another's.
LINK_KEY = ["owner", "low", "high", "app_id"]
PAIR_KEY = LINK_KEY[1:]


def owned_links(pairs: DataFrame) -> DataFrame:
    """One row for each pair and owner: its best statement and the number of statements (n)."""
    best = [use(c).alias(c) for use, c in _BEST]
    return _undirected(pairs).groupBy(*LINK_KEY).agg(*best, F.sum("n").alias("n"))


def best_links(links: DataFrame) -> DataFrame:
    """One row for each pair, over all its owners."""
    return links.groupBy(*PAIR_KEY).agg(*[use(c).alias(c) for use, c in _BEST])


def directed(best: DataFrame) -> DataFrame:
    """Both directions of each pair, as the output has them."""

    def end(x: str, y: str) -> Column:
        return F.struct(F.col(x).alias("id"), F.col(y).alias("mapping_id"), F.col(f"{x}_best").alias("best"))

    edges = best.select("app_id", _directions(end("low", "high"), end("high", "low")))
    rank = F.col("edge.best").bitwiseAND(F.lit((1 << _RANK_BITS) - 1))
    return edges.select(
        F.col("edge.id").alias("id"),
        "app_id",
        F.col("edge.mapping_id").alias("mapping_id"),
        _type(rank).alias("type"),
        F.shiftright("edge.best", _RANK_BITS).alias("event_time"),
    )


def keyed_edges(sources, settings: Settings = DEFAULT) -> DataFrame:
    """One directed edge per (id, app_id, mapping_id): the latest, then the last type. Both directions are written
    only after the winners of the undirected pairs are known."""
    return directed(best_links(_undirected(linked_pairs(sources, settings))))


def row_count(sources, settings: Settings = DEFAULT) -> DataFrame:
    """How many directed edges the source rows state, without writing them out."""
    pairs = linked_pairs(sources, settings)
    return pairs.agg((F.coalesce(F.sum("n"), F.lit(0)) * 2).alias("id_mapping_cnt"))
