"""The registered queries in SQL, over the same tables, for checking results in another engine."""

from __future__ import annotations

_LABEL = "strftime(make_timestamp(({ms} + 7200000) * 1000), '%Y-%m-%dT%H:%M:%S.%g') || '+02:00'"

# Views in dependency order; a query gets the ones up to the last it names.
_VIEWS = {
    "items": """
        select l_orderkey,
               row_number() over (partition by l_orderkey
                                  order by l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) - 1 as pos,
               cast(p_partkey as varchar) as id, p_name as name, p_brand as brand, p_type as category,
               p_retailprice as price, cast(l_quantity as int) as quantity,
               floor(p_retailprice * cast(l_quantity as int) * 100 + 0.5) / 100 as subtotal
        from lineitem join part on p_partkey = l_partkey""",
    "sale": """
        select o_orderkey, o_custkey,
               epoch_ms(cast(cast(o_orderdate as date) as timestamp)) + (o_orderkey * 7919 % 86400) * 1000
                   + o_orderkey % 1000 as sale_ms
        from orders""",
    "totals": """
        select l_orderkey, n_items, floor(gross * 100 + 0.5) / 100 as total,
               floor(gross / (1 + 0.14e0) * 100 + 0.5) / 100 as vat,
               floor((gross - gross / (1 + 0.14e0)) * 100 + 0.5) / 100 as nett
        from (select l_orderkey, count(*) as n_items,
                     cast(sum(cast(price * quantity as decimal(28, 6))) as double) as gross
              from items group by l_orderkey)""",
    "basket": f"""
        select o_orderkey, cast(o_orderkey as varchar) as "invoiceNumber",
               {_LABEL.format(ms="sale_ms")} as "saleDateTime_Ltz",
               cast(sale_ms as varchar) as "saleTimestamp_Epoc",
               cast(1 + o_orderkey % 20 as varchar) as "terminalPoint", nett, vat, total,
               cast(n_nationkey as varchar) as store_id, n_name as store_name,
               cast(c_custkey as varchar) as clerk_id, c_name as clerk_name, c_mktsegment as clerk_surname,
               cast(n_items as int) as n_items, sale_ms
        from sale join totals on l_orderkey = o_orderkey
        join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey""",
    "basket_flat": """
        select "invoiceNumber", "saleDateTime_Ltz", "saleTimestamp_Epoc", "terminalPoint", nett, vat, total,
               store_id, store_name, clerk_id, clerk_name, clerk_surname, n_items, item_ids, last_subtotal
        from basket
        join (select l_orderkey, string_agg(id, ',' order by pos) as item_ids,
                     arg_max(subtotal, pos) as last_subtotal
              from items group by l_orderkey) on l_orderkey = o_orderkey""",
    "pay0": f"""
        select o_orderkey, "invoiceNumber",
               {_LABEL.format(ms="(sale_ms + ((o_orderkey * 31) % 360) * 1000)")} as "payDateTime_Ltz",
               cast(sale_ms + ((o_orderkey * 31) % 360) * 1000 as varchar) as "payTimestamp_Epoc",
               total as paid, 'txn-' || "invoiceNumber" as "finTransactionId",
               sale_ms // 1000 + case when o_orderkey % 17 = 0 then 0 when o_orderkey % 19 = 0 then 7200
                                      else 1 + (o_orderkey * 31) % 360 end as created_s
        from basket where o_orderkey % 10 <> 0""",
    "cdc": """
        select * exclude (o_orderkey), 'I' as op, o_orderkey * 10 as seq from pay0
        union all
        select * exclude (o_orderkey) replace (paid + 1 as paid), 'U', o_orderkey * 10 + 1 from pay0
        where o_orderkey % 23 = 0
        union all
        select * exclude (o_orderkey), 'D', o_orderkey * 10 + 2 from pay0 where o_orderkey % 29 = 0""",
    "latest": """
        select * exclude (op, seq, rn) from (
            select *, row_number() over (partition by "invoiceNumber" order by seq desc) as rn from cdc)
        where rn = 1 and op <> 'D'""",
    "completed": """
        select b.*, "payDateTime_Ltz", "payTimestamp_Epoc", paid, "finTransactionId", created_s
        from latest p join basket b on p."invoiceNumber" = b."invoiceNumber" and created_s > sale_ms // 1000""",
    "completed0": """
        select b.*, "payDateTime_Ltz", "payTimestamp_Epoc", paid, "finTransactionId", created_s
        from pay0 p join basket b on p."invoiceNumber" = b."invoiceNumber" and created_s > sale_ms // 1000""",
    "unnested": """
        select "invoiceNumber" as invoicenumber, store_id, category, brand, name as product, subtotal,
               "saleDateTime_Ltz", "saleTimestamp_Epoc", pos
        from completed join items on l_orderkey = o_orderkey""",
    "unnested_upsert": """
        select invoicenumber, store_id, category, brand, product, arg_max(subtotal, pos) as subtotal,
               any_value("saleDateTime_Ltz") as "saleDateTime_Ltz",
               any_value("saleTimestamp_Epoc") as "saleTimestamp_Epoc"
        from unnested group by invoicenumber, store_id, category, brand, product""",
}

_PAYMENT = '"invoiceNumber", "payDateTime_Ltz", "payTimestamp_Epoc", paid, "finTransactionId"'
_COMPLETED = f"""
    select "invoiceNumber", "saleDateTime_Ltz", "saleTimestamp_Epoc", "terminalPoint", nett, vat, total, store_id,
           clerk_id, n_items, {_PAYMENT.split(", ", 1)[1]} from """
_BASKETS = "select * from basket_flat"
_UNNESTED = 'select * exclude (pos) from unnested'


def _with_views(query: str, upto: str) -> str:
    names = list(_VIEWS)
    views = names[: names.index(upto) + 1]
    return "with " + ",\n".join(f"{v} as materialized ({_VIEWS[v]})" for v in views) + "\n" + query


ORACLE: dict[str, str] = {
    "epoch_event_time": _with_views(
        """select cast(o_orderkey as varchar) as "invoiceNumber", cast(sale_ms as varchar) as "saleTimestamp_Epoc",
                  sale_ms // 1000 as event_s, make_timestamp(sale_ms // 1000 * 1000000) as event_utc from sale""",
        "sale"),
    "junk_event_time": _with_views(
        """select b."invoiceNumber", case when b.o_orderkey % 8 = 0 then null when b.o_orderkey % 9 = 0 then "saleTimestamp_Epoc" || 'x'
                  else "saleTimestamp_Epoc" end as "saleTimestamp_Epoc",
                  case when b.o_orderkey % 8 <> 0 and b.o_orderkey % 9 <> 0 then sale_ms // 1000 end as event_s,
                  b.o_orderkey % 8 <> 0 and b.o_orderkey % 9 <> 0 and b."invoiceNumber" in (select "invoiceNumber" from completed) as completed
           from basket b""", "completed"),
    "payments_projection": _with_views(f"select {_PAYMENT} from pay0", "pay0"),
    "line_subtotals": _with_views(
        """select cast(l_orderkey as varchar) as "invoiceNumber", id, name, brand, category, price, quantity, subtotal
           from items""", "items"),
    "basket_totals": _with_views(
        'select cast(l_orderkey as varchar) as "invoiceNumber", n_items, nett, vat, total from totals', "totals"),
    "basket_assembly": _with_views(_BASKETS, "basket_flat"),
    "cdc_normalize": _with_views(
        f"""select {_PAYMENT}, op, created_s, 999998 + seq // 10 % 2 + seq % 10 as log,
                   4000000000 - seq // 10 - seq % 10 * 1000 as "offset", cast(seq % 10 > 0 as int) as logged,
                   cast(seq % 10 as int) as row from cdc""", "cdc"),
    "cdc_normalize_pg": _with_views(
        f"""select {_PAYMENT}, op, created_s, cast(0 as bigint) as log, 999999990 + seq // 10 * 5 + seq % 10 as "offset",
                   cast(1 as int) as logged, cast(0 as int) as row from cdc""", "cdc"),
    "cdc_latest": _with_views(f"select {_PAYMENT}, created_s from latest", "latest"),
    "cdc_latest_mysql": _with_views(f"select {_PAYMENT}, created_s from latest", "latest"),
    "cdc_latest_pg": _with_views(f"select {_PAYMENT}, created_s from latest", "latest"),
    "cdc_handover": _with_views(f"select {_PAYMENT}, created_s from latest", "latest"),
    "payments_direct": _with_views(
        """select count(*) as payments,
                  cast((select count(*) from (select *, cast(null as bigint) as no_time from pay0) p
                        join basket b on p."invoiceNumber" = b."invoiceNumber" and no_time > sale_ms // 1000)
                       as bigint) as completed
           from pay0""", "pay0"),
    "sales_completed": _with_views(_COMPLETED + "completed", "completed"),
    "sales_completed_1h": _with_views(_COMPLETED + "completed where created_s <= sale_ms // 1000 + 3600", "completed"),
    "sales_completed_changelog": _with_views(_COMPLETED + "completed", "completed"),
    "unnested_sales": _with_views(_UNNESTED, "unnested"),
    "unnested_sales_upsert": _with_views("select * from unnested_upsert", "unnested_upsert"),
    "ctas_baskets": _with_views(_BASKETS, "basket_flat"),
    "ctas_payments": _with_views(f"select {_PAYMENT} from latest", "latest"),
    "ctas_completed": _with_views(_COMPLETED + "completed", "completed"),
    "table_unnested": _with_views("select * from unnested_upsert", "unnested_upsert"),
    "json_spool_roundtrip": _with_views(_BASKETS, "basket_flat"),
    "export_documents": _with_views(f"select {_PAYMENT} from pay0", "pay0"),
    "export_baskets": _with_views(_BASKETS, "basket_flat"),
    "publish_json": _with_views(_BASKETS, "basket_flat"),
    "upsert_topic": _with_views(f"select {_PAYMENT}, created_s from latest", "latest"),
    "topic_versions": _with_views(
        f"""select "invoiceNumber", "payDateTime_Ltz", "payTimestamp_Epoc", paid,
                   case when o_orderkey % 2 = 1 then "finTransactionId" end as "finTransactionId", cast(null as varchar) as reason
            from pay0 where o_orderkey % 11 <> 0 and o_orderkey % 13 <> 0 and o_orderkey % 7 <> 0 and o_orderkey % 23 <> 0
            union all
            select "invoiceNumber", null, null, null, null,
                   case when o_orderkey % 11 = 0 then 'bad header' when o_orderkey % 13 = 0 then 'unknown schema' else 'unreadable' end
            from pay0 where o_orderkey % 11 = 0 or o_orderkey % 13 = 0 or o_orderkey % 7 = 0""", "pay0"),
    "seed_dims": """
        select 'store' as kind, cast(n_nationkey as varchar) as id, n_name as name, cast(null as varchar) as surname,
               cast(null as varchar) as "storeId", cast(null as varchar) as brand, cast(null as varchar) as category,
               cast(null as double) as price from nation
        union all
        select 'clerk', cast(c_custkey as varchar), c_name, c_mktsegment, cast(c_nationkey as varchar), null, null, null
        from customer
        union all
        select 'product', cast(p_partkey as varchar), p_name, null, null, p_brand, p_type, p_retailprice from part""",
    "seed_lookup": """
        select cast(l_orderkey as varchar) as "invoiceNumber", cast(l_partkey as varchar) as product_id,
               cast(l_quantity as int) as quantity, p_name as name, p_brand as brand, p_type as category,
               p_retailprice as price
        from lineitem join part on p_partkey = l_partkey""",
    "stream_baskets": _with_views(_BASKETS, "basket_flat"),
    "upsert_payments": _with_views(f"select {_PAYMENT}, created_s from latest", "latest"),
    "upsert_completed": _with_views(_COMPLETED + "completed", "completed"),
    "upsert_unnested": _with_views("select * from unnested_upsert", "unnested_upsert"),
    "stream_newest_payments": _with_views(
        f"select {_PAYMENT}, created_s, case op when 'D' then 'D' else 'U' end as op, seq from cdc", "cdc"),
    "completed_revisions": _with_views(_COMPLETED + "completed", "completed"),
    "unnested_revisions": _with_views("select * from unnested_upsert", "unnested_upsert"),
    "topic_completed": _with_views(_COMPLETED + "completed", "completed"),
    "topic_unnested": _with_views("select * from unnested_upsert", "unnested_upsert"),
    "stream_sales_completed": _with_views(_COMPLETED + "completed0", "completed0"),
    "stream_sales_completed_1h": _with_views(
        _COMPLETED + "completed0 where created_s <= sale_ms // 1000 + 3600", "completed0"),
    "stream_unnested_sales": _with_views(
        """select "invoiceNumber" as invoicenumber, store_id, category, brand, name as product, subtotal,
                  "saleDateTime_Ltz", "saleTimestamp_Epoc" from completed0 join items on l_orderkey = o_orderkey""",
        "completed0"),
    "stream_progress": _with_views("select count(*) as records from pay0", "pay0"),
    "pipeline_end_to_end": _with_views("""
        select 'salesbaskets' as table_name, count(*) as n_rows,
               cast(sum(cast(total as decimal(18,2))) as double) as amount from basket
        union all
        select 'salespayments', count(*), cast(sum(cast(paid as decimal(18,2))) as double) from latest
        union all
        select 'salescompleted', count(*), cast(sum(cast(paid as decimal(18,2))) as double) from completed
        union all
        select 'unnested_sales', count(*), cast(sum(cast(subtotal as decimal(18,2))) as double)
        from unnested_upsert""", "unnested_upsert"),
}
ORACLE["fan_out_tables"] = ORACLE["pipeline_end_to_end"]
