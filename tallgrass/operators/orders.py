"""Orders against stock: routing, checks, conflicts, updates, undo, and the serial outcome."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallgrass.plans.lineage import cut_lineage
from tallgrass.plans.ordering import row_index, sums_before
from tallgrass.session import new_folder

KEY = ["site", "product"]


def needs(lines: DataFrame) -> DataFrame:
    """One row per order, site and product: repeated lines of a product are summed."""
    return lines.groupBy("order_id", *KEY).agg(F.sum("amount").cast("long").alias("amount"))


def number_orders(lines: DataFrame, name: str = "order_id") -> DataFrame:
    """Replace order names by their position in name order, the order of service; the name
    stays as ``order_name``."""
    places = row_index(lines.select(name).distinct(), name, name="_at")
    return lines.join(places, name).withColumnRenamed(name, "order_name").withColumnRenamed("_at", "order_id")


def lines_by_site(lines: DataFrame, span: int = 10_000) -> DataFrame:
    """The lines of each order and site as sorted lists of (product, amount).

    Products are whole numbers, so a list holds those of one ``chunk`` of ``span`` product
    numbers: no list outgrows ``span`` entries, however many lines an order has.
    """
    if span < 1:
        raise ValueError("span must be positive")
    chunk = F.floor(F.col("product") / span).alias("chunk")
    entry = F.struct("product", "amount")
    return needs(lines).groupBy("order_id", "site", chunk).agg(F.sort_array(F.collect_list(entry)).alias("lines"))


def route(lines: DataFrame, sites: DataFrame) -> DataFrame:
    """Order lines with the owner of their site; lines of unknown sites fall out."""
    return lines.join(sites, "site")


def check_stock(order_needs: DataFrame, stock: DataFrame) -> DataFrame:
    """Whether every line of an order is covered by the stock; a product without stock is not."""
    enough = F.coalesce(F.col("inventory") >= F.col("amount"), F.lit(False))
    return order_needs.join(stock, KEY, "left").groupBy("order_id").agg(F.bool_and(enough).alias("accepted"))


def earlier_conflicts(order_needs: DataFrame) -> DataFrame:
    """Orders that share a (site, product) with an earlier order, earlier meaning a smaller id.

    Only the first order of each key is looked up, so a key in a third of all orders gives
    one row per order and never pairs of orders.
    """
    firsts = order_needs.groupBy(*KEY).agg(F.min("order_id").alias("first_order"))
    return (
        order_needs.join(firsts, KEY)
        .where(F.col("first_order") < F.col("order_id"))
        .groupBy("order_id")
        .agg(F.min("first_order").alias("first_conflict"), F.count(F.lit(1)).alias("shared_keys"))
    )


def shared_keys(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.select(*KEY).intersect(right.select(*KEY))


def restock(stock: DataFrame, targets: DataFrame) -> DataFrame:
    """Set the stock of the given keys, insert the keys that are absent."""
    new = targets.select(*KEY, F.col("inventory").alias("_new"))
    return stock.join(new, KEY, "full").select(*KEY, F.coalesce("_new", "inventory").alias("inventory"))


def accepted_lines(order_needs: DataFrame, checked: DataFrame) -> DataFrame:
    """Lines of the accepted orders, as rows to append to the table of ordered products."""
    return order_needs.join(checked.where("accepted").select("order_id"), "order_id", "left_semi")


def apply_lines(stock: DataFrame, lines: DataFrame) -> DataFrame:
    """Stock after the lines are taken out; keys that would go below zero are flagged."""
    taken = lines.groupBy(*KEY).agg(F.sum("amount").alias("_taken"))
    left = (F.col("inventory") - F.coalesce("_taken", F.lit(0))).cast("long")
    return (
        stock.join(taken, KEY, "left")
        .select(*KEY, left.alias("inventory"))
        .withColumn("below_zero", F.col("inventory") < 0)
    )


def undo_stock(stock: DataFrame, prior: DataFrame, undone: DataFrame) -> DataFrame:
    """Put back the prior stock of every key an undone order touched."""
    touched = undone.select(*KEY).distinct()
    before = prior.join(touched, KEY, "left_semi").select(*KEY, F.col("inventory").alias("_before"))
    return stock.join(before, KEY, "left").select(*KEY, F.coalesce("_before", "inventory").alias("inventory"))


def undo_lines(ordered: DataFrame, undone: DataFrame) -> DataFrame:
    """Delete the lines of the undone orders."""
    return ordered.join(undone.select("order_id").distinct(), "order_id", "left_anti")


def fulfil(order_needs: DataFrame, stock: DataFrame, block: int = 65536) -> DataFrame:
    """Serve all orders one after the other, each filled whole or rejected: (order_id, accepted).

    Order ids are whole numbers in the order of service (see ``number_orders``).
    The serial result without serial work.  A line of an open order knows what the accepted
    orders before it have ``taken`` of its (site, product), and what the open ones before it ask
    for.  It fits for certain if even both together leave enough, and fails for certain if
    the taken amount alone does not.  Orders decided that way feed the next round; the first open
    order on its keys is always decided, so the rounds end.

    A round reads and writes the lines of open orders only: an accepted order is folded into the
    ``taken`` of the open lines behind it and then gone, a rejected one is gone at once.  The
    verdicts of all rounds lie in one folder, a subfolder each.  Running sums are cut into blocks,
    so a key shared by a third of the orders is spread over many tasks.
    """
    spark = order_needs.sparkSession
    verdicts = new_folder(spark, "verdicts")

    def decide(round_no: int, decided: DataFrame) -> DataFrame:
        """Write what a round decides and go on from what was written."""
        path = f"{verdicts}/round={round_no}"
        decided.select("order_id", "accepted").write.mode("overwrite").parquet(path)
        return spark.read.schema("order_id long, accepted boolean").parquet(path)

    amount, inventory, taken = F.col("amount"), F.col("inventory"), F.col("taken")
    known = cut_lineage(
        order_needs.join(stock, KEY, "left").select(
            F.col("order_id").cast("long").alias("order_id"), *KEY, "amount", F.coalesce("inventory", F.lit(-1)).alias("inventory"),
        )
    )
    # an order that asks for more than there ever was takes nothing and holds nobody up
    short = known.groupBy("order_id").agg(F.bool_or(amount > inventory).alias("_short")).where("_short")
    hopeless = decide(0, short.withColumn("accepted", F.lit(False)))
    lines = known.join(hopeless, "order_id", "left_anti").select("*", F.lit(0).cast("long").alias("taken"), F.lit(True).alias("open"))
    round_no = 0
    while True:
        round_no += 1
        sums = {"_gained": F.when(F.col("open"), F.lit(0)).otherwise(amount), "_ahead": F.when(F.col("open"), amount).otherwise(F.lit(0))}
        waiting = cut_lineage(
            sums_before(lines, KEY, "order_id", sums, block)
            .where("open")
            .select("order_id", *KEY, "amount", "inventory", (taken + F.col("_gained")).alias("taken"), "_ahead")
        )
        state = waiting.groupBy("order_id").agg(
            F.bool_and(taken + F.col("_ahead") + amount <= inventory).alias("accepted"),
            F.bool_or(taken + amount > inventory).alias("_rejected"),
        )
        final = decide(round_no, state.where("accepted OR _rejected"))
        open_lines = waiting.drop("_ahead").join(final, "order_id", "left")
        if open_lines.where("accepted IS NULL").isEmpty():
            return spark.read.schema("order_id long, accepted boolean, round int").parquet(verdicts).select("order_id", "accepted")
        # the orders accepted just now go along once more, to be folded into the lines behind them
        lines = open_lines.where("accepted IS NULL OR accepted").withColumn("open", F.col("accepted").isNull()).drop("accepted")
