"""Asset-model resource tables derived from the driver tables.

The jobs work on a *tenant*: a set of resource tables (assets, events,
time series, sequences, files, labels, relationships, raw rows, data sets).
This module derives a source and a target tenant from the TPC-H-like
driver tables with plain column arithmetic, so every resource grows with
the input scale and the same rows can be rebuilt in SQL for the oracle.

Fixed values used by the derivation (must match the SQL oracle):
  ids       data sets 500+k (source) / 900+k (target, region 3 missing)
            assets: region 1000000+k, nation 2000000+k, customer 3000000+k,
            supplier 4000000+k; target asset id = source id * 10 + 7
            series 7000000+user, sequences 8000000+order, files 9000000+page
  times     BASE_MS = 1700000000000 (2023-11-14T22:13:20Z)
  end cap   253402300800000 (year 10000) feeds the end-time clamp
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import Tables

BASE_MS = 1700000000000
HOUR_MS = 3600000
YEAR_10000_MS = 253402300800000
DYNAMIC_DDL = "struct<kind:string,num:double,str:string,bool:boolean,json:string>"


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _ms(c: str) -> Column:
    return F.unix_millis(F.col(c))


def _null(ddl: str) -> Column:
    return F.lit(None).cast(ddl)


def dyn(kind: str, num=None, s=None, b=None, js=None) -> Column:
    """A dynamic (JSON-like) value: null / number / string / bool / struct / list."""
    return F.struct(
        F.lit(kind).alias("kind"),
        (num if num is not None else _null("double")).cast("double").alias("num"),
        (s if s is not None else _null("string")).cast("string").alias("str"),
        (b if b is not None else _null("boolean")).cast("boolean").alias("bool"),
        (js if js is not None else _null("string")).cast("string").alias("json"),
    )


class DerivedTenant:
    """Resource tables of one tenant (``side`` = "source" or "target")."""

    def __init__(self, tables: Tables, side: str = "source"):
        assert side in ("source", "target")
        self.t = tables
        self.side = side

    @property
    def is_source(self) -> bool:
        return self.side == "source"

    # ------------------------------------------------------------------ data sets
    def data_sets(self) -> DataFrame:
        r = self.t("region")
        k = F.col("r_regionkey").cast("long")
        if not self.is_source:
            r = r.filter(k != 3)
        base = 500 if self.is_source else 900
        return r.select(
            (F.lit(base) + k).alias("id"),
            F.concat(F.lit("ds:"), F.col("r_name")).alias("external_id"),
            F.col("r_name").alias("name"),
            F.concat(F.lit("data set "), F.col("r_name")).alias("description"),
            F.create_map(F.lit("region"), _s(k)).alias("metadata"),
            (k % 2 == 0).alias("write_protected"),
            (F.lit(BASE_MS) + k * 1000).alias("created_time"),
            (F.lit(BASE_MS) + k * 1000 + HOUR_MS).alias("last_updated_time"),
        )

    # --------------------------------------------------------------------- assets
    def _asset_cols(self, src_id: Column, ext: Column, name: Column, parent_src: Column,
                    parent_ext: Column, descr: Column, root_src: Column, region: Column,
                    labels: Column, metadata: Column) -> list[Column]:
        def tid(c: Column) -> Column:
            return c if self.is_source else c * 10 + 7

        if self.is_source:
            ds = F.lit(500) + region
            parent_ext = _null("string")
        else:
            ds = F.when(region != 3, F.lit(900) + region)
        return [
            tid(src_id).alias("id"), ext.alias("external_id"), name.alias("name"),
            tid(parent_src).alias("parent_id"), parent_ext.alias("parent_external_id"),
            descr.alias("description"), tid(root_src).alias("root_id"),
            F.lit("tpch").alias("source"),
            (F.lit(BASE_MS) + (src_id % 1000000) * 1000).alias("created_time"),
            (F.lit(BASE_MS) + (src_id % 1000000) * 4000000).alias("last_updated_time"),
            ds.cast("long").alias("data_set_id"), labels.alias("labels"), metadata.alias("metadata"),
        ]

    def assets(self) -> DataFrame:
        r, n, c = self.t("region"), self.t("nation"), self.t("customer")
        rk = F.col("r_regionkey").cast("long")
        regions = r.select(*self._asset_cols(
            F.lit(1000000) + rk, F.concat(F.lit("R:"), _s(rk)), F.col("r_name"), _null("long"),
            _null("string"), F.concat(F.lit("region "), F.col("r_name")), F.lit(1000000) + rk, rk,
            F.array(F.lit("region")), F.create_map(F.lit("level"), F.lit("region"))))
        nk = F.col("n_nationkey").cast("long")
        nrk = F.col("n_regionkey").cast("long")
        nations = n.select(*self._asset_cols(
            F.lit(2000000) + nk, F.concat(F.lit("N:"), _s(nk)), F.col("n_name"), F.lit(1000000) + nrk,
            F.concat(F.lit("R:"), _s(nrk)), F.concat(F.lit("nation "), F.col("n_name")),
            F.lit(1000000) + nrk, nrk, F.array().cast("array<string>"),
            F.create_map(F.lit("level"), F.lit("nation"))))
        ck = F.col("c_custkey").cast("long")
        nk_c = F.col("c_nationkey").cast("long")
        c = c.select("c_custkey", "c_name", "c_mktsegment", nk_c.alias("nk"))
        if not self.is_source:
            # some customers sit under another nation at the target (moves)
            c = c.filter(ck % 10 != 9).withColumn(
                "nk", F.when(ck % 11 == 0, (F.col("nk") + 1) % 25).otherwise(F.col("nk")))
        # nation is the fixed 25-row TPC-H dimension: a bounded broadcast.
        cn = c.join(F.broadcast(n.select(F.col("n_nationkey").cast("long").alias("nk"), "n_regionkey")), "nk")
        cnk = F.col("nk")
        crk = F.col("n_regionkey").cast("long")
        src_ext = F.when(ck % 97 != 0, F.concat(F.lit("C:"), _s(ck)))
        ext = src_ext if self.is_source else F.coalesce(src_ext, _s(F.lit(3000000) + ck))
        name = F.col("c_name")
        if not self.is_source:
            name = F.when(ck % 7 == 0, F.concat(name, F.lit("-old"))).otherwise(name)
        customers = cn.select(*self._asset_cols(
            F.lit(3000000) + ck, ext, name, F.lit(2000000) + cnk, F.concat(F.lit("N:"), _s(cnk)),
            F.concat(F.lit("segment "), F.col("c_mktsegment")), F.lit(1000000) + crk, crk,
            F.array(F.concat(F.lit("seg:"), F.col("c_mktsegment"))),
            F.create_map(F.lit("level"), F.lit("customer"))))
        out = regions.unionByName(nations).unionByName(customers)
        if not self.is_source:
            s = self.t("supplier").join(F.broadcast(n.select("n_nationkey", "n_regionkey")),
                                        F.col("s_nationkey") == F.col("n_nationkey"))
            sk = F.col("s_suppkey").cast("long")
            snk = F.col("s_nationkey").cast("long")
            srk = F.col("n_regionkey").cast("long")
            suppliers = s.select(*self._asset_cols(
                F.lit(4000000) + sk, F.concat(F.lit("S:"), _s(sk)), F.col("s_name"),
                F.lit(2000000) + snk, F.concat(F.lit("N:"), _s(snk)), F.lit("supplier"),
                F.lit(1000000) + srk, srk, F.array().cast("array<string>"),
                F.create_map(F.lit("level"), F.lit("supplier"))))
            out = out.unionByName(suppliers)
        return out

    # --------------------------------------------------------------------- events
    def events(self) -> DataFrame:
        e = self.t("events")
        eid = F.col("event_id")
        ms = _ms("ts")
        u = F.col("user_id")
        a, b = F.lit(3000000) + u, F.lit(3000009) + u
        df = e.select(
            eid.alias("id"),
            F.when(eid % 13 != 0, F.concat(F.lit("ev:"), _s(eid))).alias("external_id"),
            F.when(eid % 17 == 0, F.lit(-1)).when(eid % 37 == 0, _null("long"))
             .otherwise(ms).cast("long").alias("start_time"),
            F.when(eid % 19 == 0, F.lit(-5)).when(eid % 23 == 0, ms - 1000)
             .when(eid % 29 == 0, F.lit(YEAR_10000_MS)).when(eid % 5 == 0, _null("long"))
             .otherwise(ms + (F.col("value") * 1000).cast("long")).cast("long").alias("end_time"),
            F.when(eid % 31 == 0, F.repeat(F.lit("x"), 600)).when(eid % 41 == 0, F.repeat(F.lit("y"), 500))
             .when(eid % 43 == 0, F.repeat(F.lit("z"), 501)).otherwise(F.col("props")).alias("description"),
            F.col("event_type").alias("type"),
            _s(eid % 4).alias("subtype"),
            F.lit("events").alias("source"),
            F.when(eid % 11 == 0, F.array().cast("array<bigint>"))
             .when(eid % 53 == 0, F.array(F.lit(9999999).cast("long")))
             .when(eid % 7 == 0, F.array(a, b, a)).otherwise(F.array(a, b)).alias("asset_ids"),
            ms.alias("created_time"),
            (ms + eid % 3600000).alias("last_updated_time"),
            (F.lit(500) + u % 6).alias("data_set_id"),
            F.create_map(F.lit("user"), _s(u)).alias("metadata"),
        )
        if not self.is_source:
            # an older copy of every third event, keyed by external id
            df = df.filter(eid % 3 == 0).select(
                _null("long").alias("id"),
                F.coalesce(F.col("external_id"), _s(F.col("id"))).alias("external_id"),
                "start_time", "end_time", F.lit("old").alias("description"), "type", "subtype",
                "source", F.array().cast("array<bigint>").alias("asset_ids"), "created_time",
                (F.col("last_updated_time") - 86400000).alias("last_updated_time"),
                _null("long").alias("data_set_id"), "metadata")
        return df

    # ----------------------------------------------------------------- time series
    def ts_headers(self) -> DataFrame:
        u = F.col("user_id")
        return self.t("events").select("user_id").distinct().select(
            (F.lit(7000000) + u).alias("id"),
            F.when(u % 13 != 0, F.concat(F.lit("ts:"), _s(u))).alias("external_id"),
            F.when(u % 20 == 0, F.concat(F.lit("SYS-"), _s(u)))
             .otherwise(F.concat(F.lit("series "), _s(u))).alias("name"),
            F.concat(F.lit("user "), _s(u)).alias("description"),
            (u % 25 == 0).alias("is_string"),
            (u % 3 == 0).alias("is_step"),
            F.lit("kW").alias("unit"),
            (F.lit(3000000) + u).alias("asset_id"),
            F.when(u % 10 == 3, F.array(F.lit(1).cast("long"), F.lit(2).cast("long")))
             .otherwise(F.array().cast("array<bigint>")).alias("security_categories"),
            (F.lit(BASE_MS) + u * 1000).alias("created_time"),
            (F.lit(BASE_MS) + u * 60000000).alias("last_updated_time"),
            (F.lit(500) + u % 6).alias("data_set_id"),
            F.create_map(F.lit("user"), _s(u)).alias("metadata"),
        )

    def ts_points(self) -> DataFrame:
        """Points: one per (series, millisecond); string series carry the event type."""
        u = F.col("user_id")
        pts = (self.t("events")
               .groupBy(u.alias("user_id"), _ms("ts").alias("timestamp"))
               .agg(F.max("value").alias("v"), F.max("event_type").alias("vs")))
        is_string = u % 25 == 0
        return pts.select(
            (F.lit(7000000) + u).alias("id"),
            F.when(u % 13 != 0, F.concat(F.lit("ts:"), _s(u))).alias("external_id"),
            F.col("timestamp"),
            F.when(~is_string, F.col("v")).alias("value"),
            F.when(is_string, F.col("vs")).alias("value_string"),
        )

    # ------------------------------------------------------------------ sequences
    def sequence_headers(self) -> DataFrame:
        o = self.t("orders")
        k = F.col("o_orderkey")

        def column(name, ext, descr, vtype, mkey):
            return F.struct(F.lit(name).alias("name"), F.lit(ext).alias("external_id"),
                            F.lit(descr).alias("description"), F.lit(vtype).alias("value_type"),
                            F.create_map(F.lit("kind"), F.lit(mkey)).alias("metadata"),
                            F.lit(BASE_MS).alias("created_time"), F.lit(BASE_MS).alias("last_updated_time"))

        return o.select(
            (F.lit(8000000) + k).alias("id"),
            F.when(k % 97 != 0, F.concat(F.lit("seq:"), _s(k))).alias("external_id"),
            F.concat(F.lit("order "), _s(k)).alias("name"),
            F.col("o_orderpriority").alias("description"),
            (F.lit(3000000) + F.col("o_custkey")).alias("asset_id"),
            F.create_map(F.lit("status"), F.col("o_orderstatus")).alias("metadata"),
            F.array(column("quantity", "qty", "line quantity", "DOUBLE", "measure"),
                    column("price", "price", "extended price", "DOUBLE", "money"),
                    column("flag", "flag", "return flag", "STRING", "code"),
                    column("late", "late", "line status F", "BOOLEAN", "status")).alias("columns"),
            _ms("o_orderdate").alias("created_time"),
            (_ms("o_orderdate") + (k % 1000) * HOUR_MS).alias("last_updated_time"),
            (F.lit(500) + F.col("o_custkey") % 6).alias("data_set_id"),
        )

    def sequence_rows(self) -> DataFrame:
        """Rows of every sequence: (id, external_id, row_number, values[])."""
        from pyspark.sql import Window
        li = self.t("lineitem")
        k = F.col("l_orderkey")
        # numbered by the sequence's id, so that joins with the headers find the rows dealt and sorted already
        w = Window.partitionBy("id").orderBy(
            "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
        return li.withColumn("id", F.lit(8000000) + k).select(
            "id",
            F.when(k % 97 != 0, F.concat(F.lit("seq:"), _s(k))).alias("external_id"),
            (F.row_number().over(w) - 1).cast("long").alias("row_number"),
            F.array(
                dyn("number", num=F.col("l_quantity")),
                F.when(F.col("l_partkey") % 50 == 0, dyn("null"))
                 .otherwise(dyn("number", num=F.col("l_extendedprice"))),
                dyn("string", s=F.col("l_returnflag")),
                dyn("bool", b=F.col("l_linestatus") == "F"),
            ).alias("values"),
        )

    def sequence_body(self) -> DataFrame:
        """Bodies of every sequence: some NULL or without rows, some with fewer cells than columns or fewer columns."""
        k = F.col("id") - 8000000
        rows = self.sequence_rows().groupBy("id").agg(F.array_sort(F.collect_list(F.struct("row_number", "values"))).alias("rows"))
        heads = self.sequence_headers().select("id", "external_id", F.transform(
            "columns", lambda c: F.struct(c["external_id"].alias("external_id"))).alias("columns"))
        short = F.transform("rows", lambda r: F.struct(r["row_number"].alias("row_number"), F.slice(r["values"], 1, 2).alias("values")))
        none = F.slice("rows", 1, 0)
        return heads.join(rows, "id", "left").select(
            "id", "external_id", F.when(k % 11 == 0, F.slice("columns", 1, 3)).otherwise(F.col("columns")).alias("columns"),
            F.when(k % 13 == 0, F.lit(None)).when(k % 17 == 0, none).when(k % 7 == 0, short).otherwise(F.col("rows")).alias("rows"))

    # ---------------------------------------------------------------------- files
    def files(self) -> DataFrame:
        p = self.t("pages")
        k = F.col("page_id")
        name = (F.when(k % 5 == 0, F.concat(F.lit("page-"), _s(k), F.lit(".html")))
                .when(k % 7 == 0, F.translate(F.col("url"), "/", "\\"))
                .when(k % 11 == 0, F.concat(F.col("url"), F.lit("\\x")))
                .otherwise(F.col("url")))
        uploaded = k % 4 != 0
        return p.select(
            (F.lit(9000000) + k).alias("id"),
            F.when(k % 13 != 0, F.concat(F.lit("file:"), _s(k))).alias("external_id"),
            (F.lit(BASE_MS) + k * 1000).alias("source_created_time"),
            (F.lit(BASE_MS) + k * 1000 + HOUR_MS).alias("source_modified_time"),
            name.alias("name"),
            F.lit("/web").alias("directory"),
            F.lit("text/html").alias("mime_type"),
            F.lit("crawler").alias("source"),
            F.when(k % 17 == 0, F.array().cast("array<bigint>"))
             .otherwise(F.array(F.lit(3000000) + k, F.lit(3000000) + k * 2)).alias("asset_ids"),
            F.array().cast("array<bigint>").alias("security_categories"),
            F.array(F.concat(F.lit("lb:"), _s(k % 5)), F.concat(F.lit("lb:bad"), _s(k % 3))).alias("labels"),
            uploaded.alias("uploaded"),
            F.when(uploaded, F.lit(BASE_MS) + k * 1000 + 60000).alias("uploaded_time"),
            (F.lit(BASE_MS) + k * 1000).alias("created_time"),
            (F.lit(BASE_MS) + (k % 250) * 40000000).alias("last_updated_time"),
            (F.lit(500) + k % 6).alias("data_set_id"),
            F.create_map(F.lit("length"), _s(F.length("html"))).alias("metadata"),
            F.col("html").alias("content"),
        )

    # --------------------------------------------------------------------- labels
    def labels(self) -> DataFrame:
        r = self.t("region")
        k = F.col("r_regionkey").cast("long")
        if not self.is_source:
            r = r.filter(k < 4)
        by_region = r.select(
            F.concat(F.lit("lb:"), _s(k)).alias("external_id"),
            F.concat(F.lit("label "), F.col("r_name")).alias("name"),
            F.lit("region label").alias("description"),
            ((500 if self.is_source else 900) + k).alias("data_set_id"),
            (F.lit(BASE_MS) + k * 1000).alias("created_time"),
        )
        if not self.is_source:
            return by_region
        brands = self.t("part").select("p_brand").distinct().select(
            F.col("p_brand").alias("external_id"), F.lower("p_brand").alias("name"),
            _null("string").alias("description"), _null("long").alias("data_set_id"),
            _null("long").alias("created_time"))
        return by_region.unionByName(brands)

    # -------------------------------------------------------------- relationships
    def relationships(self) -> DataFrame:
        li = self.t("lineitem")
        p, s = F.col("l_partkey"), F.col("l_suppkey")
        agg = li.groupBy(p.alias("p"), s.alias("s")).agg(
            F.min(_ms("l_shipdate")).alias("start_time"),
            F.max(_ms("l_shipdate")).alias("end_time"),
            F.round(F.avg("l_discount"), 4).alias("confidence"))
        p, s = F.col("p"), F.col("s")
        return agg.select(
            F.concat(F.lit("rel:"), _s(p), F.lit(":"), _s(s)).alias("external_id"),
            F.concat(F.lit("P:"), _s(p)).alias("source_external_id"),
            F.lit("ASSET").alias("source_type"),
            F.concat(F.lit("S:"), _s(s)).alias("target_external_id"),
            F.when(s % 2 == 0, F.lit("ASSET")).otherwise(F.lit("EVENT")).alias("target_type"),
            "start_time", "end_time", "confidence",
            (F.lit(500) + p % 6).alias("data_set_id"),
            F.array(F.concat(F.lit("lb:"), _s(p % 5))).alias("labels"),
            F.col("start_time").alias("created_time"),
            F.col("end_time").alias("last_updated_time"),
        )

    # ------------------------------------------------------------------------ raw
    def raw_rows(self) -> DataFrame:
        """Rows of raw tables: db 'geo' (nation, region), db 'sales' (supplier, part)."""
        def rows(df, db, table, key, cols):
            keys, vals = zip(*cols)
            return df.select(
                F.lit(db).alias("db_name"), F.lit(table).alias("table_name"), _s(key).alias("key"),
                (F.lit(BASE_MS) + key.cast("long") * 4000000).alias("last_updated_time"),
                F.map_from_arrays(F.array(*[F.lit(x) for x in keys]), F.array(*vals)).alias("columns"))

        nk = F.col("n_nationkey")
        nation = rows(self.t("nation"), "geo", "nation", nk, [
            ("name", dyn("string", s=F.col("n_name"))),
            ("region", dyn("number", num=F.col("n_regionkey"))),
            ("ref", dyn("struct", js=F.concat(F.lit('{"region":'), _s(F.col("n_regionkey")), F.lit("}")))),
            ("note", F.when(nk % 5 == 0, dyn("null")).otherwise(dyn("bool", b=nk % 2 == 0))),
        ])
        region = rows(self.t("region"), "geo", "region", F.col("r_regionkey"), [
            ("name", dyn("string", s=F.col("r_name"))),
        ])
        supplier = rows(self.t("supplier"), "sales", "supplier", F.col("s_suppkey"), [
            ("name", dyn("string", s=F.col("s_name"))),
            ("acctbal", dyn("number", num=F.col("s_acctbal"))),
            ("nation", dyn("number", num=F.col("s_nationkey"))),
        ])
        part = rows(self.t("part"), "sales", "part", F.col("p_partkey"), [
            ("name", dyn("string", s=F.col("p_name"))),
            ("brand", dyn("string", s=F.col("p_brand"))),
            ("size", dyn("number", num=F.col("p_size"))),
            ("tags", F.when(F.col("p_size") % 10 == 0, dyn("list", js=F.lit('["big","round"]')))
             .otherwise(dyn("null"))),
        ])
        out = nation.unionByName(region).unionByName(supplier).unionByName(part)
        if not self.is_source:
            # target holds an older copy of geo only
            out = out.filter(F.col("db_name") == "geo").withColumn(
                "last_updated_time", F.col("last_updated_time") - 86400000)
        return out

