"""The store x family x date panel view over the star-schema test tables.

Mapping (all derived by Spark from the given tables, so the work grows with them):

* sales fact  = lineitem ⋈ part ⋈ supplier grouped by (store_nbr = s_nationkey,
  family = p_type, date = ship date); sales = sum(quantity),
  onpromotion = number of lines with discount >= 0.09
* dense panel = every series × every date from the first sale date to
  train_end + horizon; missing train days are 0, horizon sales are null
* stores      = nation ⋈ region (city = nation name, state = region name,
  cluster = region key, store_type = letter by nation key / 5)
* transactions = orders ⋈ customer counted per (order date, customer nation)
* oil         = max order price per order date, null on weekends
* holidays    = calendar rules per year of the panel, named after regions/nations
* train_end   = last order date (transactions end there, as in the original data)

Scalars (first date, train_end) are scalar subqueries (``DataFrame.scalar()``),
so nothing is collected to the driver and the plan stays one job.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.operators.densify import densify
from shelfcast.sources.tables import read_parquet_table

HORIZON = 16
PROMO_DISCOUNT = 0.09

# Fixed holiday rules (type, locale, month, day, transferred, description),
# applied to every calendar year the panel spans. Order is the file order.
NATIONAL_RULES = [
    ("Holiday", 1, 1, False, "Primer dia del ano"),
    ("Bridge", 12, 24, False, "Puente Navidad"),
    ("Holiday", 12, 25, False, "Navidad"),
    ("Additional", 12, 26, False, "Navidad+1"),
    ("Work Day", 12, 29, False, "Recupero puente Navidad"),
    ("Holiday", 8, 10, True, "Primer Grito de Independencia"),
    ("Transfer", 8, 11, False, "Traslado Primer Grito de Independencia"),
    ("Event", 5, 14, False, "Dia de la Madre"),
]
# Regional holiday of region k: month 3 + k, day 10. Local holiday of
# nation n: month (n mod 12) + 1, day n + 1.
REGIONAL_DAY = 10
REGIONAL_FIRST_MONTH = 3


class PanelSources:
    """Lazily built DataFrames of one data directory.

    Attributes are cached per instance so one query plan reuses the same
    logical subtrees (Spark then reuses their exchanges).
    """

    def __init__(self, spark: SparkSession, sf_dir: str, horizon: int = HORIZON):
        self.spark = spark
        self.sf_dir = sf_dir
        self.horizon = horizon
        self.is_materialized = False

    def materialized(self) -> "PanelSources":
        """A copy whose dense panel is checkpointed into the shared checkpoint
        folder and whose date bounds are constants.

        For multi-branch jobs (feature matrix, model fits) the panel would
        otherwise be rebuilt from the line items in every branch. The
        checkpoint keeps the (store, family) partitioning, so series windows
        over it need no exchange; two dates are read back to the driver.
        """
        if self.is_materialized:
            return self
        from shelfcast.session import cut_lineage, session_table
        m = type(self)(self.spark, self.sf_dir, **self.options())

        def build():
            panel = cut_lineage(self.panel)
            lo, hi = panel.agg(F.min("date"),
                               F.max(F.when(F.col("sales").isNotNull(), F.col("date")))).first()
            return panel, lo, hi
        panel, lo, hi = session_table(
            self.spark, ("panel", type(self).__name__, *self.options().values()), self.sf_dir, build)
        m.__dict__["panel"] = panel
        m.__dict__["series"] = panel.select("store_nbr", "family").distinct()
        m.__dict__["first_date"] = F.lit(lo)
        m.__dict__["train_end"] = F.lit(hi)
        m.is_materialized = True
        return m

    def options(self) -> dict:
        """What a copy of these sources is made with."""
        return {"horizon": self.horizon}

    def table(self, name: str) -> DataFrame:
        return read_parquet_table(self.spark, self.sf_dir, name)

    # ------------------------------------------------------------------ facts
    @cached_property
    def sales_fact(self) -> DataFrame:
        li = self.table("lineitem").select(
            "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_shipdate")
        part = self.table("part").select("p_partkey", "p_type")
        supp = self.table("supplier").select("s_suppkey", "s_nationkey")
        return (li.join(part, li.l_partkey == part.p_partkey)
                  .join(supp, li.l_suppkey == supp.s_suppkey)
                  .groupBy(F.col("s_nationkey").cast("int").alias("store_nbr"),
                           F.col("p_type").alias("family"),
                           F.to_date("l_shipdate").alias("date"))
                  .agg(F.sum("l_quantity").alias("sales"),
                       F.count_if(F.col("l_discount") >= F.lit(PROMO_DISCOUNT))
                        .cast("int").alias("onpromotion")))

    @property
    def panel_fact(self) -> DataFrame:
        """The fact up to the panel's last day. Line items shipped later are in
        no panel; the bound stands on the ship date, below the joins."""
        return self.sales_fact.filter(F.col("date") <= self.panel_end)

    @cached_property
    def first_date(self) -> Column:
        """First ship date: a scalar subquery reading one line-item column."""
        return self.table("lineitem").select(F.min(F.to_date("l_shipdate"))).scalar()

    @cached_property
    def train_end(self) -> Column:
        """Last known day: the last order date (scalar subquery)."""
        return self.table("orders").select(F.max(F.to_date("o_orderdate"))).scalar()

    @property
    def panel_end(self) -> Column:
        return F.date_add(self.train_end, self.horizon)

    @cached_property
    def series(self) -> DataFrame:
        # count(*) keeps Catalyst from collapsing this into a second scan of the
        # line items: the fact's exchange is reused instead.
        return (self.panel_fact.groupBy("store_nbr", "family")
                .agg(F.count(F.lit(1)).alias("_n")).select("store_nbr", "family"))

    @cached_property
    def store_list(self) -> DataFrame:
        """Stores that sell in the panel: suppliers semi-joined with the line
        items' supplier keys (two columns read, nothing aggregated)."""
        li = self.table("lineitem").where(F.to_date("l_shipdate") <= self.panel_end)
        return (self.table("supplier").join(li, F.col("s_suppkey") == F.col("l_suppkey"), "left_semi")
                .select(F.col("s_nationkey").cast("int").alias("store_nbr")).distinct())

    @cached_property
    def calendar(self) -> DataFrame:
        """One row per day of the panel (date grain; bounded by the date span)."""
        return self.spark.range(1).select(
            F.explode(F.sequence(self.first_date, self.panel_end)).alias("date"))

    @cached_property
    def panel(self) -> DataFrame:
        """Dense panel: (store_nbr, family, date, sales, onpromotion).

        Gap filling by ``densify`` (one window over the fact, no grid join):
        missing train days are 0, horizon days have sales null. The result is
        clustered by (store_nbr, family), the key of every series window.
        """
        dense = densify(self.panel_fact, ["store_nbr", "family"], "date",
                        self.first_date, self.panel_end,
                        {"sales": 0.0, "onpromotion": 0})
        in_train = F.col("date") <= self.train_end
        return dense.select(
            "store_nbr", "family", "date",
            F.when(in_train, F.col("sales")).alias("sales"),
            F.col("onpromotion").cast("int").alias("onpromotion"))

    @cached_property
    def families(self) -> DataFrame:
        """Family code = rank of the family name (a small dimension)."""
        part = self.table("part")
        fam = (part.join(self.table("lineitem"), F.col("p_partkey") == F.col("l_partkey"), "left_semi")
               .select(F.col("p_type").alias("family")).distinct())
        return fam.select(
            "family",
            (F.dense_rank().over(_global_order("family")) - 1).alias("family_code"))

    def with_id(self, df: DataFrame) -> DataFrame:
        """Deterministic row id from the key (mixed radix, no collisions):
        id = (days since start · n_stores + store_nbr) · n_families + family code,
        with n_stores = max store key + 1 and n_families from the family table
        (both scalar subqueries)."""
        days = F.datediff(F.col("date"), self.first_date).cast("long")
        n_store = self.stores.select((F.max("store_nbr") + 1).cast("long")).scalar()
        n_fam = self.families.select(F.count(F.lit(1)).cast("long")).scalar()
        return (df.join(self.families, "family", "left")
                  .withColumn("id", (days * n_store + F.col("store_nbr").cast("long")) * n_fam
                              + F.col("family_code").cast("long"))
                  .drop("family_code"))

    # ------------------------------------------------------------ dimensions
    @cached_property
    def stores(self) -> DataFrame:
        nation = self.table("nation").select("n_nationkey", "n_name", "n_regionkey")
        region = self.table("region").select("r_regionkey", "r_name")
        letters = F.lit("ABCDE")
        pos = (F.floor(F.col("n_nationkey") / 5).cast("int") + 1)
        return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            F.col("n_nationkey").cast("int").alias("store_nbr"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
            F.substring(letters, pos, F.lit(1)).alias("store_type"),
            F.col("n_regionkey").cast("int").alias("cluster"))

    @cached_property
    def transactions(self) -> DataFrame:
        orders = self.table("orders").select("o_custkey", "o_orderdate")
        cust = self.table("customer").select("c_custkey", "c_nationkey")
        return (orders.join(cust, orders.o_custkey == cust.c_custkey)
                .groupBy(F.to_date("o_orderdate").alias("date"),
                         F.col("c_nationkey").cast("int").alias("store_nbr"))
                .agg(F.count(F.lit(1)).alias("transactions")))

    @cached_property
    def oil(self) -> DataFrame:
        """Macro price series: one row per order date, null on weekends."""
        orders = self.table("orders").select("o_orderdate", "o_totalprice")
        daily = orders.groupBy(F.to_date("o_orderdate").alias("date")).agg(
            F.max("o_totalprice").alias("_p"))
        return daily.select(
            "date",
            F.when(F.weekday("date") < 5, F.col("_p")).alias("dcoilwtico"))

    @cached_property
    def holidays(self) -> DataFrame:
        """Event calendar: (date, type, locale, locale_name, description,
        transferred, h_seq). ``h_seq`` is the file order within a day."""
        years = F.explode(F.sequence(F.year(self.first_date), F.year(self.panel_end)))
        rules = F.array(*[
            F.struct(F.lit(i).alias("rule"), F.lit(t).alias("type"), F.lit(m).alias("month"),
                     F.lit(d).alias("day"), F.lit(tr).alias("transferred"),
                     F.lit(desc).alias("description"))
            for i, (t, m, d, tr, desc) in enumerate(NATIONAL_RULES)])
        national = (self.spark.range(1).select(years.alias("year"))
                    .select("year", F.explode(rules).alias("r"))
                    .select(F.make_date("year", "r.month", "r.day").alias("date"),
                            "r.type", F.lit("National").alias("locale"),
                            F.lit("Ecuador").alias("locale_name"), "r.description",
                            "r.transferred", F.col("r.rule").cast("long").alias("h_seq")))
        region = self.table("region").select("r_regionkey", "r_name", years.alias("year"))
        regional = region.select(
            F.make_date("year", F.col("r_regionkey") + REGIONAL_FIRST_MONTH,
                        F.lit(REGIONAL_DAY)).alias("date"),
            F.lit("Holiday").alias("type"), F.lit("Regional").alias("locale"),
            F.col("r_name").alias("locale_name"),
            F.concat(F.lit("Fundacion de "), F.col("r_name")).alias("description"),
            F.lit(False).alias("transferred"),
            (F.col("r_regionkey") + 100).cast("long").alias("h_seq"))
        nation = self.table("nation").select("n_nationkey", "n_name", years.alias("year"))
        local = nation.select(
            F.make_date("year", F.pmod(F.col("n_nationkey"), F.lit(12)) + 1,
                        F.col("n_nationkey") + 1).alias("date"),
            F.lit("Holiday").alias("type"), F.lit("Local").alias("locale"),
            F.col("n_name").alias("locale_name"),
            F.concat(F.lit("Fiesta de "), F.col("n_name")).alias("description"),
            F.lit(False).alias("transferred"),
            (F.col("n_nationkey") + 200).cast("long").alias("h_seq"))
        return national.unionByName(regional).unionByName(local)

    # -------------------------------------------------------------- combined
    def train_rows(self) -> DataFrame:
        return self.panel.filter(F.col("date") <= self.train_end)

    def horizon_rows(self) -> DataFrame:
        return self.panel.filter(F.col("date") > self.train_end).drop("sales")


def _global_order(col: str):
    from pyspark.sql import Window
    return Window.orderBy(col)
