"""The given tables seen as the sources of a linkage.

Every view is a projection or a key join of whole tables; the same views are written as SQL in
``views_sql`` for the comparison.
"""

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.plans.labels import LABELS
from casebook.plans.run import Sources

COHORTS = ("C01", "C02")
# fixed values: code -> cluster, active in the reference set
CLUSTER_ROWS = """
    ('75367002', 'BP_COD', 1), ('271649006', 'BPSYS_COD', 1), ('49436004', 'AFIB_COD', 1),
    ('196371000000102', 'AFIBRES_COD', 1), ('38341003', 'HYP_COD', 1), ('38341003', 'OLD_COD', 0),
    ('162659009', 'HYPRES_COD', 1), ('431855005', 'CKD_COD', 1), ('230690007', 'STRK_COD', 1),
    ('44054006', 'DMTYPE2AUDIT_COD', 1), ('44054006', 'DM_COD', 1)
"""
# fixed values: code -> ethnicity
ETHNICITY_ROWS = """
    ('92391000000108', 'A'), ('92411000000108', 'B'), ('92461000000105', 'Z')
"""
SMOKING = {"current": ["77176002"], "ex": ["8517006"], "never": ["266919005"]}
EXTRACT_KEY = ("person_id", "birth_date", "extract_date", "sex", "practice", "time_stamp", "meta_practice")
TIE_COLUMNS = ("practice", "sex", "lsoa", "ethnicity", "time_stamp", "meta_practice")
FIRST_READING = "1997-01-01"
LAST_DEATH = "2001-06-30"


def day(column: str) -> Column:
    return F.col(column).cast("date")


def whole(column: str) -> Column:
    return F.col(column).cast("int")


class Tables:
    """The given tables as attributes, and the views made from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        table = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        setattr(self, name, table)
        return table

    @cached_property
    def person(self) -> DataFrame:
        """Customers as people, with ten-digit ids (some of them invalid)."""
        start = F.when(F.col("c_nationkey") == 24, 999000000).otherwise(400000000)
        number = (start + F.col("c_custkey")).cast("string")
        total = F.aggregate(
            F.sequence(F.lit(1), F.lit(9)), F.lit(0),
            lambda sum_, i: sum_ + (F.ascii(F.substring(number, i, F.lit(1))) - 48) * (11 - i),
        )
        check = (F.lit(11) - total % 11) % 11 % 10
        region = F.when(F.col("c_nationkey") >= 20, "W").otherwise("E")
        initial = F.substring("c_mktsegment", 1, 1)
        offset = (F.col("c_custkey") * 37 % 32850).cast("int")
        return self.customer.select(
            F.col("c_custkey").alias("person_no"),
            F.concat(number, check.cast("string")).alias("person_id"),
            F.date_add(F.lit("1905-01-01").cast("date"), offset).alias("birth_date"),
            F.when(F.col("c_acctbal") < 4500, "1").otherwise("2").alias("sex"),
            F.concat(region, F.lpad(F.col("c_nationkey").cast("string"), 8, "0")).alias("lsoa"),
            F.when(initial == "F", "Z").otherwise(initial).alias("ethnicity"),
        )

    @cached_property
    def order_person(self) -> DataFrame:
        """Orders with their person."""
        return self.orders.join(self.person, F.col("o_custkey") == F.col("person_no"))

    @cached_property
    def line_person(self) -> DataFrame:
        """Order lines with their order and person, and a unique key, which is made after the join."""
        key = F.concat_ws(
            "-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", whole("l_quantity"),
            day("l_shipdate"),
        )
        lines = self.lineitem.join(self.order_person, F.col("l_orderkey") == F.col("o_orderkey"))
        return lines.withColumn("line_key", key)

    @cached_property
    def extracts(self) -> DataFrame:
        """Order lines as extract rows, with up to three journal entries each."""
        line, flag, status = F.col("l_linenumber"), F.col("l_returnflag"), F.col("l_linestatus")
        quantity, ship = whole("l_quantity"), day("l_shipdate")

        def by_flag(a: str, n: str, r: Column | str) -> Column:
            return F.when(flag == "A", a).when(flag == "N", n).otherwise(r)

        smoked = F.when(status == "F", "77176002").otherwise("8517006")
        group = by_flag("92391000000108", "92411000000108", "92461000000105")
        code = (
            F.when(line == 1, "271649006")
            .when(line == 2, "271650006")
            .when(line == 3, "75367002")
            .when(line == 4, by_flag("49436004", "196371000000102", "398036000"))
            .when(line == 5, by_flag("38341003", "162659009", "431855005"))
            .when(line == 6, by_flag("230690007", "44054006", smoked))
            .otherwise(F.when(status == "F", group).otherwise("266919005"))
        )
        value1 = (
            F.when(line == 1, F.when(quantity <= 2, 40).otherwise(90 + 2 * quantity))
            .when(line == 2, 50 + quantity)
            .when(line == 3, 100 + 2 * quantity)
        )
        value2 = F.when((line == 3) & (F.col("l_tax") < 0.07), 60 + quantity)

        def entry(at: Column, code: Column | str, v1, v2) -> Column:
            return F.struct(
                at.alias("journal_date"),
                (F.lit(code) if isinstance(code, str) else code).alias("code"),
                v1.cast("string").alias("value1"),
                v2.cast("string").alias("value2"),
            )

        nothing = F.lit(None)
        pair = entry(F.date_sub(ship, quantity), "75367002", 110 + quantity, 70 + quantity)
        pressure = entry(F.date_sub(ship, 30), "38341003", nothing, nothing)
        entries = F.array(
            F.when(F.col("l_tax") > 0, entry(ship, code, value1, value2)),
            F.when(flag != "N", pair),
            F.when((status == "F") & (quantity > 25), pressure),
        )
        cohort = F.when(F.col("o_orderstatus") == "F", "C01").when(
            F.col("o_orderstatus") == "O", "C02"
        )
        return self.line_person.select(
            "person_id", "birth_date",
            F.trunc(F.add_months(ship, 3), "quarter").alias("extract_date"),
            cohort.otherwise("C03").alias("cohort"),
            "sex", "lsoa", "ethnicity",
            F.col("o_orderpriority").alias("practice"),
            ship.cast("string").alias("time_stamp"),
            F.col("line_key").alias("meta_practice"),
            F.floor(F.datediff(ship, "birth_date") / 365.25).cast("int").alias("age"),
            F.month(ship).alias("ship_month"),
            F.filter(entries, lambda e: e.isNotNull()).alias("journal"),
        )

    @property
    def annual(self) -> DataFrame:
        """Extract rows of the first quarter of a year."""
        return self.extracts.where("ship_month <= 3").drop("ship_month")

    @property
    def quarterly(self) -> DataFrame:
        """Extract rows of the other quarters."""
        return self.extracts.where("ship_month > 3").drop("ship_month")

    @cached_property
    def line_part(self) -> DataFrame:
        """Order lines with their part."""
        return self.lineitem.join(self.part, F.col("l_partkey") == F.col("p_partkey"))

    @staticmethod
    def _episode() -> list[Column]:
        """The columns of a hospital episode, made from an order line and its part."""
        quantity, ship, size = whole("l_quantity"), day("l_shipdate"), F.col("p_size")
        kind, flag = F.col("p_type"), F.col("l_returnflag")
        code = (
            F.when(kind == "ECONOMY", "I21 9")
            .when(kind == "LARGE", "I639")
            .when(kind == "MEDIUM", "I50 0")
            .when(kind == "PROMO", "J189")
            .when(kind == "SMALL", "R69X")
            .otherwise("K52 ")
        )
        second = F.when(flag == "A", "I10X, E119").when(flag == "N", "Z501").otherwise("I61")
        no_spell = (flag == "R") & (F.col("l_linenumber") == 7)
        key = F.concat_ws(
            "-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", quantity, ship
        )
        return [
            key.alias("record_id"),
            F.col("l_orderkey").alias("order_no"),
            ship.alias("record_start_date"),
            F.date_add(ship, quantity).alias("record_end_date"),
            code.alias("DIAG_4_01"),
            F.concat(code, F.lit(", "), second).alias("DIAG_4_CONCAT"),
            F.when(size == 1, F.lit("1800-01-01").cast("date")).otherwise(ship)
            .alias("admission_date"),
            F.when(size == 2, F.lit("1801-01-01").cast("date"))
            .otherwise(F.date_add(ship, quantity)).alias("discharge_date"),
            F.when(F.col("l_linestatus") == "F", "21").otherwise("11,2A").alias("admission_method"),
            F.when(size < 45, F.concat(F.lit("E"), F.lpad(size.cast("string"), 8, "0")))
            .alias("lsoa"),
            F.when(flag == "N", "Z").otherwise(flag).alias("ethnicity"),
            F.when(no_spell, "-1").otherwise(F.col("l_orderkey").cast("string")).alias("spell_id"),
            size.alias("part_size"),
            (F.year(ship) + 20).alias("fyear"),
        ]

    @cached_property
    def admitted_records(self) -> DataFrame:
        """Order lines as hospital episodes, without identifiers."""
        return self.line_part.select(*self._episode())

    @cached_property
    def admitted(self) -> DataFrame:
        """Hospital episodes with identifiers; some birth dates and ids are placeholders.

        Lines meet their orders before the episode's texts are made, so only the lines are shuffled.
        """
        people = self.order_person.select("o_orderkey", "person_id", "birth_date", "sex")
        lines = self.line_part.join(people, F.col("l_orderkey") == F.col("o_orderkey"))
        rows = lines.select(*self._episode(), "person_id", "birth_date", "sex")
        size = F.col("part_size")
        return rows.withColumns(
            {
                "person_id": F.when(size == 4, "0000000000").otherwise(F.col("person_id")),
                "birth_date": F.when(size == 3, F.lit("1801-01-01").cast("date")).otherwise(
                    F.col("birth_date")
                ),
            }
        ).drop("order_no", "part_size", "fyear")

    @cached_property
    def deaths_raw(self) -> DataFrame:
        """Orders as death registrations; most are not current, cancelled or from elsewhere."""
        price, died = F.col("o_totalprice"), day("o_orderdate")
        month = F.month(died)
        code = (
            F.when(month <= 3, "I219").when(month <= 6, "I64").when(month <= 9, "I500")
            .otherwise("C349")
        )
        urgent = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT")
        current = urgent & (price <= 450000)
        registered = F.date_add(died, F.floor(price / 20000).cast("int"))
        return self.order_person.select(
            F.col("o_orderkey").cast("string").alias("death_id"),
            F.when(price < 250000, F.col("person_id")).alias("confirmed_id"),
            F.when(price < 480000, F.col("person_id")).alias("unconfirmed_id"),
            F.date_format("birth_date", "yyyyMMdd").alias("birth_date"),
            F.date_format(died, "yyyyMMdd").alias("date_of_death"),
            F.date_format(registered, "yyyy-MM-dd").alias("registration_date"),
            "sex",
            code.alias("code"),
            F.concat_ws(",", code, F.when(price > 100000, "I634"), F.when(price > 300000, "E119"))
            .alias("code_array"),
            F.when(price > 60000, F.col("lsoa")).alias("residence"),
            F.col("lsoa").alias("location"),
            F.when(current, "True").otherwise("False").alias("current"),
            F.when(price < 20000, "Y").otherwise("N").alias("cancelled"),
        )

    @cached_property
    def outpatient(self) -> DataFrame:
        """Orders as outpatient appointments."""
        priority = F.col("o_orderpriority")
        ethnicity = (
            F.when(priority == "1-URGENT", "A").when(priority == "2-HIGH", "B")
            .when(priority == "3-MEDIUM", "Z").when(priority == "4-NOT SPECIFIED", "M")
        )
        return self.order_person.select(
            "person_id", "birth_date", F.lit(LABELS.outpatient).alias("dataset"),
            day("o_orderdate").alias("record_start_date"), ethnicity.alias("ethnicity"),
        )

    @cached_property
    def emergency(self) -> DataFrame:
        """Events as emergency attendances."""
        kind = F.col("event_type")
        ethnicity = (
            F.when(kind == "click", "H").when(kind == "view", "9").when(kind == "purchase", "B")
            .when(kind == "signup", "A").otherwise("")
        )
        rows = self.events.join(self.person, F.col("user_id") == F.col("person_no"))
        return rows.select(
            "person_id", "birth_date", F.lit(LABELS.emergency).alias("dataset"),
            day("ts").alias("record_start_date"), ethnicity.alias("ethnicity"),
        )

    @cached_property
    def cluster_ref(self) -> DataFrame:
        """Codes and their clusters."""
        return self.spark.sql(f"SELECT * FROM VALUES {CLUSTER_ROWS} AS t(ref_code, cluster, active)")

    @cached_property
    def ethnicity_ref(self) -> DataFrame:
        """Codes and the ethnicity they state."""
        return self.spark.sql(f"SELECT * FROM VALUES {ETHNICITY_ROWS} AS t(ref_code, ethnicity)")

    @property
    def sources(self) -> Sources:
        """All inputs of a full run."""
        return Sources(
            annual=self.annual,
            quarterly=self.quarterly,
            admitted=self.admitted,
            outpatient=self.outpatient,
            emergency=self.emergency,
            deaths=self.deaths_raw,
            cluster_ref=self.cluster_ref,
            ethnicity_ref=self.ethnicity_ref,
        )
