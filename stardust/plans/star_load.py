"""Star-schema load from raw JSON staging.

One batch = the staging rows of one micro-batch. The loads run in dependency
order: customers and products (siblings), then reviews and orders (they look
up the dimensions' surrogate keys). Each load is a pure DataFrame function of
(current table, staging) -> next table, so the same code serves the batch
job, the streaming ``foreachBatch`` and the oracle checks.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import jsonpath as J
from ..operators import dedup as D
from ..operators import upsert as U
from ..session import for_lookup, materialize, no_rows

TS = T.TimestampNTZType()

CUSTOMERS = T.StructType([
    T.StructField("customer_key", T.LongType()), T.StructField("customer_id", T.StringType()),
    T.StructField("email", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("address", T.StringType()), T.StructField("created_at", TS),
    T.StructField("updated_at", TS), T.StructField("is_active", T.BooleanType())])
PRODUCTS = T.StructType([
    T.StructField("product_key", T.LongType()), T.StructField("product_id", T.StringType()),
    T.StructField("name", T.StringType()), T.StructField("category", T.StringType()),
    T.StructField("price", T.DecimalType(38, 2)), T.StructField("created_at", TS),
    T.StructField("updated_at", TS), T.StructField("is_active", T.BooleanType())])
ORDERS = T.StructType([
    T.StructField("order_id", T.LongType()), T.StructField("order_date", T.DateType()),
    T.StructField("customer_key", T.LongType()), T.StructField("product_key", T.LongType()),
    T.StructField("quantity", T.IntegerType()), T.StructField("created_at", TS)])
REVIEWS = T.StructType([
    T.StructField("review_id", T.StringType()), T.StructField("order_id", T.LongType()),
    T.StructField("customer_key", T.LongType()), T.StructField("product_key", T.LongType()),
    T.StructField("review_date", T.DateType()), T.StructField("star_rating", T.IntegerType()),
    T.StructField("review_body", T.StringType()), T.StructField("helpful_votes", T.IntegerType()),
    T.StructField("verified_purchase", T.StringType()), T.StructField("created_at", TS)])
SCHEMAS = {"customers": CUSTOMERS, "products": PRODUCTS, "orders": ORDERS, "reviews": REVIEWS}

# Paths read from each staged record and their types (natural keys are text).
STAGED_FIELDS = {
    "customer_id": "string", "email": "string", "name": "string", "address": "string",
    "product_id": "string", "product_title": "string", "product_category": "string", "price": "decimal(38,2)",
    "review_id": "string", "order_id": "bigint", "review_date": "date", "star_rating": "int",
    "review_body": "string", "helpful_votes": "int", "verified_purchase": "string", "quantity": "int",
}


@dataclass(frozen=True)
class Star:
    customers: DataFrame
    products: DataFrame
    orders: DataFrame
    reviews: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {"customers": self.customers, "products": self.products, "orders": self.orders, "reviews": self.reviews}


def empty_star(spark: SparkSession) -> Star:
    return Star(**{n: no_rows(spark, s) for n, s in SCHEMAS.items()})


def typed_staging(stg: DataFrame, order: list[str], mydata: str = "mydata") -> DataFrame:
    """E1 + E3 once per batch: one row per record (array documents unnested,
    bare objects kept), every path cast once; ``order`` columns (arrival) and
    the element position are kept for "latest" tie-breaks."""
    flat = J.flatten(stg, mydata, "f0", keep=order)
    return flat.select(*order, "f0_pos", *[J.get("f0", k, t).alias(k) for k, t in STAGED_FIELDS.items()])


def staged(rows: DataFrame, order: list[str], records: str) -> DataFrame:
    """One row per typed record of ``records``."""
    return rows.select(*order, F.posexplode(records).alias("f0_pos", "__r")).select(
        *order, "f0_pos", *[F.col("__r")[k].alias(k) for k in STAGED_FIELDS])


def record_type(fields: dict[str, str]) -> str:
    return "struct<" + ", ".join(f"{n}: {t}" for n, t in fields.items()) + ">"


def typed_records(v: str | Column) -> Column:
    """A document's records (an array's elements, or the bare object) in one walk over
    it: all staged paths of a record as a struct; what is absent or not castable is null."""
    kind = record_type(STAGED_FIELDS)
    return F.coalesce(J.get(v, "$", f"array<{kind}>"), F.array(J.get(v, "$", kind)))


FLAT = "__f_"  # before the names of a bare object's fields


def typed_document(docs: DataFrame, v: str, keep: list[str], also: dict[str, str]) -> DataFrame:
    """``typed_records`` with the fields of a bare object as columns of their own, of which
    a scan reads the ones it needs; ``__many`` has an array's records, and is null beside
    them. ``also``: further fields of the document, of the same walk."""
    walk = docs.select("*", J.get(v, "$", f"array<{record_type(STAGED_FIELDS)}>").alias("__many"),
                       J.get(v, "$", record_type({**STAGED_FIELDS, **also})).alias("__r"))
    names = [n for n in also if n not in STAGED_FIELDS]
    return walk.select(*keep, *[F.col("__r")[n].alias(f"__o_{n}") for n in names], "__many", *[F.col("__r")[n].alias(f"{FLAT}{n}") for n in STAGED_FIELDS])


def staged_documents(rows: DataFrame, order: list[str], arrays: bool) -> DataFrame:
    """One row per record of ``typed_document``'s rows; ``arrays``: some are arrays."""
    flat = (rows.where("__many is null") if arrays else rows).select(*order, F.lit(0).alias("f0_pos"), *[F.col(f"{FLAT}{n}").alias(n) for n in STAGED_FIELDS])
    return flat.unionByName(staged(rows.where("__many is not null"), order, "__many")) if arrays else flat


def _latest(st: DataFrame, key: str, order: list[str]) -> DataFrame:
    # E4 + W1: rows with the key, newest per key (QUALIFY ROW_NUMBER() ... DESC = 1).
    return D.latest(st.where(F.col(key).isNotNull()), key,
                    [F.col(c) for c in order] + [F.col("f0_pos")])


FEW = 1 << 25    # repeated hashes beyond which all rows are ordered
CELLS = 1 << 27  # cells of the largest bitmap of repeated hashes that is broadcast (16 MB)


def _cell(cells: int) -> Column:
    return F.pmod(F.col("__h"), F.lit(cells))


def repeat_bitmap(again: DataFrame, n: int) -> tuple[DataFrame, int]:
    """The cells of ``n`` hashes ``__h`` as bits, 16 cells a hash but ``CELLS`` at most:
    ``row`` of 4,096 cells, ``words`` of 64 each (rows without a bit are left out), and the
    number of cells."""
    cells = min(CELLS, max(4096, 1 << (16 * n - 1).bit_length()))
    word = F.shiftright(_cell(cells), 6)
    words = again.groupBy(word.alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(__h, {cells}L) & 63 as int))")).alias("bits"))
    row = words.groupBy(F.shiftright("word", 6).alias("row")).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("word").bitwiseAND(63), "bits"))).alias("at"))  # 64 entries at most
    each = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.coalesce(F.try_element_at("at", i.cast("long")), F.lit(0).cast("long")))
    return materialize(row.select("row", each.alias("words")), "repeat-bitmap"), cells


def latest_of_few_repeats(st: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``_latest`` for a key that names few rows twice: the 64-bit hashes of the keys are
    counted, a row in no cell of a repeated hash stays where it is, and only the others are
    dealt by their key and ordered (a cell holds all rows of a hash, so a hash that comes
    once may be among them). What is broadcast is a bitmap of the cells, of bounded size;
    where the hashes that repeat are many, all rows are ordered. Reads ``st``, which should
    be a written table, twice or more."""
    some = st.where(F.col(key).isNotNull()).withColumn("__h", F.xxhash64(key))
    seen = Observation()
    again = some.groupBy("__h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("__h")
    again = materialize(again.observe(seen, F.count(F.lit(1)).alias("n")), "repeated-keys")
    if not seen.get["n"]:
        return some.drop("__h")
    if seen.get["n"] > FEW:
        return _latest(st, key, order)
    bits, cells = repeat_bitmap(again, seen.get["n"])
    hit = (F.shiftright(_cell(cells), 12) == F.col("row")) & F.expr(
        f"getbit(words[cast((pmod(__h, {cells}L) >> 6) & 63 as int)], cast(pmod(__h, {cells}L) & 63 as int)) = 1")
    once = some.join(F.broadcast(bits), hit, "left_anti")
    return once.unionByName(_latest(some.join(F.broadcast(bits), hit, "left_semi"), key, order)).drop("__h")


def customers_source(st: DataFrame, order: list[str]) -> DataFrame:
    return _latest(st, "customer_id", order).select("customer_id", "email", "name", "address")


def merge_customers(customers: DataFrame, src: DataFrame, now: Column, key_floor: int | None = None, part: bool = False) -> DataFrame:
    """M2: update email, name, address, updated_at; insert with new keys (K1, M7)."""
    return U.upsert(customers, src, ["customer_id"], ["email", "name", "address"],
                    on_update={"updated_at": now},
                    on_insert={"created_at": now, "updated_at": now, "is_active": F.lit(True)},
                    surrogate="customer_key", key_floor=key_floor, part=part)


def load_customers(customers: DataFrame, st: DataFrame, order: list[str], now: Column) -> DataFrame:
    """M2: latest per customer_id, merged."""
    return merge_customers(customers, customers_source(st, order), now)


def products_source(st: DataFrame, order: list[str]) -> DataFrame:
    return _latest(st, "product_id", order).select(
        "product_id", F.col("product_title").alias("name"), F.col("product_category").alias("category"), "price")


def merge_products(products: DataFrame, src: DataFrame, now: Column, key_floor: int | None = None, part: bool = False) -> DataFrame:
    """M3: update name, category, price, updated_at."""
    return U.upsert(products, src, ["product_id"], ["name", "category", "price"],
                    on_update={"updated_at": now},
                    on_insert={"created_at": now, "updated_at": now, "is_active": F.lit(True)},
                    surrogate="product_key", key_floor=key_floor, part=part)


def load_products(products: DataFrame, st: DataFrame, order: list[str], now: Column) -> DataFrame:
    return merge_products(products, products_source(st, order), now)


def _keys(st: DataFrame, customers: DataFrame, products: DataFrame, how: str) -> DataFrame:
    """Natural -> surrogate key lookups (dimensions are small next to
    facts; Spark broadcasts them when their measured size allows)."""
    c = customers.select("customer_id", "customer_key")
    p = products.select("product_id", "product_key")
    return st.join(c, "customer_id", how).join(p, "product_id", how)


def reviews_source(st: DataFrame, customers: DataFrame, products: DataFrame, order: list[str]) -> DataFrame:
    """Latest per review_id (T19) of the reviews whose customer and product are known;
    the others go to ``unmatched_reviews`` (T2: the fact's keys are never null)."""
    return latest_reviews(_keys(st, customers, products, "inner"), order)


def latest_reviews(keyed: DataFrame, order: list[str], ids: tuple[str, str] = ("customer_key", "product_key"), latest=_latest) -> DataFrame:
    return latest(keyed, "review_id", order).select(
        "review_id", "order_id", *ids, "review_date", "star_rating",
        "review_body", "helpful_votes", "verified_purchase")


def merge_reviews(reviews: DataFrame, src: DataFrame, now: Column, part: bool = False) -> DataFrame:
    """M4: update only star_rating and helpful_votes."""
    return U.upsert(reviews, src, ["review_id"], ["star_rating", "helpful_votes"], on_insert={"created_at": now}, part=part)


def load_reviews(reviews: DataFrame, st: DataFrame, customers: DataFrame, products: DataFrame,
                 order: list[str], now: Column) -> DataFrame:
    return merge_reviews(reviews, reviews_source(st, customers, products, order), now)


def orders_source(st: DataFrame, customers: DataFrame, products: DataFrame, order: list[str]) -> DataFrame:
    """Inner lookups, quantity defaults to 1 (E5), latest per order_id."""
    return latest_orders(_keys(st, customers, products, "inner"), order)


def latest_orders(keyed: DataFrame, order: list[str], ids: tuple[str, str] = ("customer_key", "product_key")) -> DataFrame:
    return _latest(keyed, "order_id", order).select(
        "order_id", F.col("review_date").alias("order_date"), *ids,
        F.coalesce("quantity", F.lit(1)).alias("quantity"))


def merge_orders(orders: DataFrame, src: DataFrame, now: Column, part: bool = False) -> DataFrame:
    """M5: update only quantity."""
    return U.upsert(orders, src, ["order_id"], ["quantity"], on_insert={"created_at": now}, part=part)


def load_orders(orders: DataFrame, st: DataFrame, customers: DataFrame, products: DataFrame,
                order: list[str], now: Column) -> DataFrame:
    return merge_orders(orders, orders_source(st, customers, products, order), now)


def unmatched_reviews(st: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Staged reviews whose customer or product has no dimension row (a
    null id has none), with what is missing."""
    r = st.where(F.col("review_id").isNotNull())

    def without(dim: DataFrame, key: str) -> DataFrame:
        # Null ids take no part in the join, which would deal them all to one task.
        known = r.where(F.col(key).isNotNull()).join(dim.select(key), key, "left_anti")
        return r.where(F.col(key).isNull()).unionByName(known)

    c = without(customers, "customer_id").withColumn("missing", F.lit("customer"))
    p = without(products, "product_id").withColumn("missing", F.lit("product"))
    return c.unionByName(p)


NATURAL = ("customer_id", "product_id")


def with_ids(st: DataFrame) -> DataFrame:
    """The staged rows that name a customer and a product."""
    return st.where(F.col("customer_id").isNotNull() & F.col("product_id").isNotNull())


def batch_reviews(st: DataFrame, customers: DataFrame, products: DataFrame, order: list[str], cut: bool = True) -> DataFrame:
    """``reviews_source`` where the dimensions hold, once each, all ids of the batch (its own
    loads put them there): the rows with both ids are the known ones, so that only the
    latest per review is looked up, without the order columns. A review comes once in a
    batch as a rule: with ``cut`` (``st`` is a written table) only those that do not are ordered."""
    latest = latest_of_few_repeats if cut else _latest
    return _keys(latest_reviews(with_ids(st), order, NATURAL, latest), customers, products, "inner").select(
        *[c for c in REVIEWS.fieldNames() if c != "created_at"])


def batch_orders(st: DataFrame, customers: DataFrame, products: DataFrame, order: list[str]) -> DataFrame:
    """``orders_source``, likewise."""
    return _keys(latest_orders(with_ids(st), order, NATURAL), customers, products, "inner").select(
        *[c for c in ORDERS.fieldNames() if c != "created_at"])


def load_batch(star: Star, stg: DataFrame, now: Column, order: list[str] | None = None,
               mydata: str = "mydata", cut: bool = True, quarantine: str | None = None) -> Star:
    """Q2 for one batch (C10 order: dimensions, then facts). The typed staging
    is read by all four loads, both dimensions by the facts and each batch's source by
    all joins of its merge, so they are written once to the shared folder (``cut``). Reviews without a customer or product go
    to the folder ``quarantine`` (T2)."""
    order = order or ["loaded_timestamp"]
    st = typed_staging(stg, order, mydata)
    if cut:
        st = materialize(st, "staging")
    once = materialize if cut else lambda df, _label: df
    seek = for_lookup if cut else lambda df: df
    customers = once(merge_customers(star.customers, seek(once(customers_source(st, order), "customers-batch")), now), "customers")
    products = once(merge_products(star.products, seek(once(products_source(st, order), "products-batch")), now), "products")
    known = (seek(customers), seek(products))
    if quarantine:
        unmatched_reviews(st, *known).write.parquet(quarantine)
    reviews = merge_reviews(star.reviews, seek(once(batch_reviews(st, *known, order, cut), "reviews-batch")), now)
    orders = merge_orders(star.orders, seek(once(batch_orders(st, *known, order), "orders-batch")), now)
    return replace(star, customers=customers, products=products, reviews=reviews, orders=orders)


def nested_orders_insert(orders: DataFrame, stg: DataFrame, customers: DataFrame, products: DataFrame,
                         now: Column, mydata: str = "mydata") -> DataFrame:
    """M6 (nested draft shape): documents are arrays of orders with a customer
    object and a products array; insert one row per (order_id, product_key)
    not yet present."""
    f0 = J.flatten(stg, mydata, "o", keep=[])
    f1 = J.flatten_nested(f0, "o", "products", "p")
    rows = f1.select(J.get("o", "order_id", "bigint").alias("order_id"),
                     J.get("o", "order_date", "date").alias("order_date"),
                     J.get("o", "customer.customer_id").alias("customer_id"),
                     J.get("p", "product_id").alias("product_id"),
                     F.coalesce(J.get("p", "quantity", "int"), F.lit(1)).alias("quantity"))
    keyed = _keys(rows, customers, products, "inner").select(
        "order_id", "order_date", "customer_key", "product_key", "quantity").distinct()
    return U.insert_only(orders, keyed, ["order_id", "product_key"], on_insert={"created_at": now})
