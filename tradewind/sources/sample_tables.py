"""The sample star schema and event tables seen as warehouse inputs.

Everything is derived row by row (no join, no window), so each input works on ``spark.read`` and
``spark.readStream`` alike and grows with its table. The roles are made up: customers are buyers,
parts are skus, nations are provinces, events are page views and cart, favour and comment actions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tradewind.codes import APPRAISE, ORDER_STATUS, PAYMENT_TYPE
from tradewind.schemas import AMOUNT, ROUTING_RULE

EPOCH = 1704067200  # 2024-01-01 00:00:00, where the events start
PERIOD = 30 * 86400
TRUNCATED_EVERY = 97


def _text(second: str) -> str:
    """Epoch seconds as 'yyyy-MM-dd HH:mm:ss'."""
    return f"date_format(timestamp_seconds({second}), 'yyyy-MM-dd HH:mm:ss')"


def _order_second(key: str) -> str:
    return f"({EPOCH} + {key} * 7919 % {PERIOD})"


def _name_id(name: str) -> str:
    """Numeric id of a name: the first 28 bits of its MD5."""
    return f"conv(substring(md5({name}), 1, 7), 16, 10)"


def _money(column: str) -> str:
    return f"CAST({column} AS {AMOUNT})"


def _birthday(key: str) -> str:
    return f"date_format(date_add(DATE '1950-01-01', CAST({key} % 20000 AS INT)), 'yyyy-MM-dd')"


class SampleTables:
    """Warehouse inputs from one table directory, as tables or (``stream=True``) as streams."""

    def __init__(self, spark: SparkSession, path: str, stream: bool = False, **options: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.stream = stream
        self.options = options
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self._open(name)
        return self._tables[name]

    def _open(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.path}/{name}.parquet")
        if self.stream:
            reader = self.spark.readStream.schema(df.schema).options(**self.options)
            df = reader.option("pathGlobFilter", f"{name}.parquet").parquet(self.path)
        times = {c for c, kind in df.dtypes if kind.startswith("timestamp")}
        return df.selectExpr(
            *[f"CAST({c} AS TIMESTAMP) AS {c}" if c in times else c for c in df.columns]
        )

    # -- logs ---------------------------------------------------------------------------------

    def _events(self) -> DataFrame:
        return self.table("events").selectExpr("*", "CAST(get_json_object(props, '$.k') AS INT) AS k")

    def page_log(self) -> DataFrame:
        return self._events().selectExpr(
            "event_id AS seq",
            "CAST(user_id AS STRING) AS mid",
            "'v' || (k % 3) AS vc",
            "element_at(array('store', 'web', 'partner', 'ad'), k % 4 + 1) AS ch",
            "CAST(user_id % 25 AS STRING) AS ar",
            "if(k % 2 = 0, '1', '0') AS is_new",
            "CASE event_type WHEN 'click' THEN 'good_detail' WHEN 'view' THEN 'home' "
            "WHEN 'signup' THEN 'register' WHEN 'purchase' THEN 'trade' ELSE 'error' END AS page_id",
            "CASE WHEN event_type <> 'view' "
            "THEN element_at(array('home', 'search', 'good_list'), k % 3 + 1) END AS last_page_id",
            "CASE WHEN event_type = 'click' THEN CAST(k AS STRING) END AS item",
            "CASE WHEN event_type = 'click' THEN 'sku_id' END AS item_type",
            "CAST(floor(value * 1000) AS BIGINT) AS during_time",
            "slice(array(named_struct('item', CAST(k + 1 AS STRING), 'item_type', 'sku_id'), "
            "named_struct('item', CAST(k + 2 AS STRING), 'item_type', 'sku_id'), "
            "named_struct('item', CAST(k + 3 AS STRING), 'item_type', 'activity_id')), 1, k % 4) AS displays",
            "unix_millis(ts) AS ts",
            "k",
        )

    def log_lines(self) -> DataFrame:
        """Raw click-log text; a tenth are app starts, every 97th line is cut short."""
        common = "struct(ar, ch, is_new, mid, vc) AS common"
        page = "struct(page_id, last_page_id, item, item_type, during_time) AS page"
        start = "named_struct('entry', 'icon', 'loading_time', k) AS start"
        line = self.page_log().selectExpr(
            "seq",
            f"if(k % 10 = 7, to_json(struct({common}, {start}, ts)), "
            f"to_json(struct({common}, {page}, displays, ts))) AS line",
        )
        # The generator makes the text a column of its own: a filter on it must not be rewritten over
        # the long expression above, which stands in for reading a text file.
        return line.selectExpr(
            f"explode(array(if(seq % {TRUNCATED_EVERY} = 0, substring(line, 1, length(line) - 5), line))) "
            "AS value",
            "seq",
        )

    def search_pages(self) -> DataFrame:
        """Documents as search page views, one per second; the text is what was searched for."""
        return self.table("documents").selectExpr(
            "'search' AS last_page_id",
            "text AS item",
            f"({EPOCH} + doc_id % {PERIOD}) * 1000 AS ts",
            "CASE lang WHEN 'en' THEN 'SEARCH' WHEN 'fr' THEN 'ORDER' WHEN 'de' THEN 'CART' "
            "WHEN 'es' THEN 'CLICK' END AS source",
        )

    # -- facts --------------------------------------------------------------------------------

    def order_info(self) -> DataFrame:
        second = _order_second("o_orderkey")
        finished, paid, unpaid = (ORDER_STATUS[s] for s in ("finished", "paid", "unpaid"))
        return self.table("orders").selectExpr(
            "o_orderkey AS id",
            "o_custkey % 25 AS province_id",
            f"CASE o_orderstatus WHEN 'F' THEN '{finished}' WHEN 'P' THEN '{paid}' ELSE '{unpaid}' END "
            "AS order_status",
            "o_custkey AS user_id",
            f"{_money('o_totalprice')} AS total_amount",
            f"{_money('0')} AS activity_reduce_amount",
            f"{_money('0')} AS coupon_reduce_amount",
            f"CAST({_money('o_totalprice')} + {_money('o_orderkey % 20')} AS {AMOUNT}) AS original_total_amount",
            f"{_money('o_orderkey % 20')} AS feight_fee",
            f"{_text(second + ' + 900')} AS expire_time",
            f"{_text(second)} AS create_time",
            f"{_text(second + ' + 1')} AS operate_time",
        )

    def order_detail(self) -> DataFrame:
        """Lines written -6 to +6 seconds around their order, so both ends of +-5 are met and missed."""
        second = _order_second("l_orderkey") + " + l_partkey % 13 - 6"
        return self.table("lineitem").selectExpr(
            "l_orderkey * 10 + l_linenumber AS id",
            "l_orderkey AS order_id",
            "l_partkey AS sku_id",
            f"{_money('l_extendedprice')} AS order_price",
            "CAST(l_quantity AS BIGINT) AS sku_num",
            "'sku ' || l_partkey AS sku_name",
            f"{_text(second)} AS create_time",
            f"{_money('l_extendedprice')} AS split_total_amount",
            f"{_money('l_discount')} AS split_activity_amount",
            f"{_money('l_tax')} AS split_coupon_amount",
        )

    def payment_info(self) -> DataFrame:
        """One payment per finished order, -6 to +6 seconds around it."""
        second = _order_second("o_orderkey") + " + o_orderkey % 13 - 6"
        types = ", ".join(f"'{code}'" for code in PAYMENT_TYPE.values())
        return self.table("orders").filter("o_orderstatus = 'F'").selectExpr(
            "o_orderkey + 1000000000 AS id",
            "o_orderkey AS order_id",
            "o_custkey AS user_id",
            f"{_money('o_totalprice')} AS total_amount",
            "'order ' || o_orderkey AS subject",
            f"element_at(array({types}), CAST(o_orderkey % 3 AS INT) + 1) AS payment_type",
            f"{_text(second)} AS create_time",
            f"{_text(second + ' + 2')} AS callback_time",
        )

    def refund_info(self) -> DataFrame:
        return self.table("lineitem").filter("l_returnflag = 'R'").selectExpr(
            "l_orderkey AS order_id",
            "l_partkey AS sku_id",
            f"{_money('l_extendedprice')} AS refund_amount",
            f"{_text(_order_second('l_orderkey'))} AS create_time",
        )

    def _actions(self, event: str) -> DataFrame:
        return self._events().filter(f"event_type = '{event}'").selectExpr(
            "event_id AS id",
            "user_id",
            "CAST(k AS BIGINT) AS sku_id",
            f"if(k % 2 = 0, '{APPRAISE['good']}', '{APPRAISE['bad']}') AS appraise",
            "date_format(ts, 'yyyy-MM-dd HH:mm:ss') AS create_time",
        )

    def favor_info(self) -> DataFrame:
        return self._actions("signup")

    def cart_info(self) -> DataFrame:
        return self._actions("purchase")

    def comment_info(self) -> DataFrame:
        return self._actions("error")

    # -- dimensions ---------------------------------------------------------------------------

    def dim_user(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "CAST(c_custkey AS STRING) AS id",
            "if(c_custkey % 2 = 0, 'F', 'M') AS gender",
            f"{_birthday('c_custkey')} AS birthday",
        )

    def dim_province(self) -> DataFrame:
        return self.table("nation").selectExpr(
            "CAST(n_nationkey AS STRING) AS id",
            "n_name AS name",
            "'1' || lpad(CAST(n_nationkey AS STRING), 5, '0') AS area_code",
            "'N-' || n_nationkey AS iso_code",
            "'R' || n_regionkey || '-' || n_nationkey AS iso_3166_2",
        )

    def dim_sku(self) -> DataFrame:
        return self.table("part").selectExpr(
            "CAST(p_partkey AS STRING) AS id",
            "p_name || ' ' || p_partkey AS sku_name",
            f"CAST({_money('p_retailprice')} AS STRING) AS price",
            f"{_name_id('p_name')} AS spu_id",
            f"{_name_id('p_brand')} AS tm_id",
            f"{_name_id('p_type')} AS category3_id",
        )

    def _names(self, column: str, name: str) -> DataFrame:
        names = self.table("part").selectExpr(f"{column} AS {name}").distinct()
        return names.selectExpr(f"{_name_id(name)} AS id", name)

    def dim_spu(self) -> DataFrame:
        return self._names("p_name", "spu_name")

    def dim_trademark(self) -> DataFrame:
        return self._names("p_brand", "tm_name")

    def dim_category3(self) -> DataFrame:
        return self._names("p_type", "name")

    # -- row changes --------------------------------------------------------------------------

    def cdc_records(self) -> DataFrame:
        """Changes of four source tables; three changes per user id, ``seq`` in key order."""
        no_before = "CAST(NULL AS STRING) AS before"
        users = (
            self.table("customer")
            .selectExpr(
                "c_custkey AS seq",
                "element_at(array('CREATE', 'UPDATE', 'READ', 'DELETE', 'UPDATE'), "
                "CAST(c_custkey % 5 AS INT) + 1) AS op",
                "to_json(named_struct('id', c_custkey div 3, 'name', c_name, "
                "'gender', CASE WHEN c_custkey % 7 <> 0 THEN if(c_custkey % 2 = 0, 'F', 'M') END, "
                f"'birthday', {_birthday('c_custkey')}, 'segment', c_mktsegment), "
                "map('ignoreNullFields', 'false')) AS row",
            )
            .selectExpr(
                "'sql.shop.user_info' AS topic",
                "CASE WHEN op IN ('UPDATE', 'DELETE') THEN row END AS before",
                "CASE WHEN op <> 'DELETE' THEN row END AS after",
                "op",
                "seq",
            )
        )
        skus = self.table("part").selectExpr(
            "'sql.shop.sku_info' AS topic",
            no_before,
            "to_json(named_struct('id', p_partkey, 'sku_name', p_name, "
            f"'price', CAST({_money('p_retailprice')} AS STRING), 'size', p_size)) AS after",
            "'CREATE' AS op",
            "p_partkey AS seq",
        )
        orders = self.table("orders").selectExpr(
            "'sql.shop.order_info' AS topic",
            no_before,
            "to_json(named_struct('id', o_orderkey, 'user_id', o_custkey, "
            f"'total_amount', CAST({_money('o_totalprice')} AS STRING), 'priority', o_orderpriority)) AS after",
            "if(o_orderstatus = 'O', 'CREATE', 'UPDATE') AS op",
            "o_orderkey AS seq",
        )
        nations = self.table("nation").selectExpr(
            "'sql.shop.base_nation' AS topic",
            no_before,
            "to_json(named_struct('id', n_nationkey, 'name', n_name)) AS after",
            "'CREATE' AS op",
            "CAST(n_nationkey AS BIGINT) AS seq",
        )
        return users.unionByName(skus).unionByName(orders).unionByName(nations)

    def routing_rules(self) -> DataFrame:
        user = "id,name,gender,birthday"
        rows = [
            ("user_info", "insert", "hbase", "dim_user_info", "id,name", None, None, 1),
            ("user_info", "insert", "hbase", "dim_user_info", user, None, None, 2),
            ("user_info", "update", "hbase", "dim_user_info", user, None, None, 3),
            ("user_info", "read", "hbase", "dim_user_info", user, "id", None, 4),
            ("sku_info", "insert", "hbase", "dim_sku_info", "id,sku_name,price", "id", None, 5),
            ("order_info", "insert", "kafka", "dwd_order_info", "id,user_id,total_amount", None, None, 6),
        ]
        return self.spark.createDataFrame(rows, ROUTING_RULE)
