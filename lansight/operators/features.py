"""D10 per-window per-MAC behaviour features and D11 unsupervised outliers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lansight.config import DEFAULT, ArpConfig

c = F.col

FEATURES = ("packets", "requests", "replies", "garps", "unique_targets", "unique_src_ips", "reply_request_ratio")


def mac_features(df: DataFrame, cfg: ArpConfig = DEFAULT) -> DataFrame:
    """Per (window, eth_src): traffic mix, distinct targets of its requests,
    distinct sender IPs, reply/request ratio."""
    w = F.window("event_ts", f"{cfg.feature_window} seconds").alias("window")
    level1 = df.groupBy(w, "eth_src", "arp_dst_ip", "arp_src_ip").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(c("is_request")).alias("n_req"),
        F.count_if(c("is_reply")).alias("n_rep"), F.count_if(c("is_gratuitous")).alias("n_garp"))
    agg = level1.groupBy("window", "eth_src").agg(
        F.sum("n").cast("bigint").alias("packets"),
        F.sum("n_req").cast("bigint").alias("requests"),
        F.sum("n_rep").cast("bigint").alias("replies"),
        F.sum("n_garp").cast("bigint").alias("garps"),
        F.count_distinct(F.when(c("n_req") > 0, c("arp_dst_ip"))).alias("unique_targets"),
        F.count_distinct(c("arp_src_ip")).alias("unique_src_ips"),
    )
    return agg.select(
        c("window.start").alias("window_start"), "eth_src", "packets", "requests", "replies", "garps",
        "unique_targets", "unique_src_ips",
        (c("replies").cast("double") / F.greatest(c("requests"), F.lit(1)).cast("double")).alias("reply_request_ratio"),
    )


def mac_outliers(df: DataFrame, cfg: ArpConfig = DEFAULT) -> DataFrame:
    """KMeans over standardised features; rows of the smaller cluster(s) are
    outliers, with their distance to the cluster centre.  Fitting is distributed
    (MLlib); only the k centres reach the driver."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import StandardScaler, VectorAssembler

    from lansight.session import shared_dir

    shared_dir(df.sparkSession)  # makes sure checkpoint() has the cluster's shared folder
    # KMeans passes over its input once per iteration: cut the lineage once into
    # the shared checkpoint folder (reliable; survives executor loss)
    feats = mac_features(df, cfg).checkpoint()
    vec = VectorAssembler(inputCols=list(FEATURES), outputCol="raw_features").transform(feats)
    scaled = StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True) \
        .fit(vec).transform(vec)
    model = KMeans(k=cfg.outlier_k, seed=cfg.outlier_seed, featuresCol="features", predictionCol="cluster").fit(scaled)
    centres = model.clusterCenters()
    pred = model.transform(scaled)
    # k rows: one per cluster, so broadcasting them is bounded by k
    sizes = pred.groupBy("cluster").agg(F.count(F.lit(1)).alias("cluster_size"))
    sizes = sizes.withColumn("is_outlier", c("cluster_size") < F.max("cluster_size").over(Window.partitionBy()))
    from pyspark.ml.functions import vector_to_array

    arr = vector_to_array(c("features"))
    dist = None
    for i, centre in enumerate(centres):
        d = F.sqrt(F.aggregate(
            F.zip_with(arr, F.array(*[F.lit(float(v)) for v in centre]), lambda a, b: (a - b) * (a - b)),
            F.lit(0.0), lambda acc, x: acc + x))
        dist = F.when(c("cluster") == i, d) if dist is None else dist.when(c("cluster") == i, d)
    return pred.join(F.broadcast(sizes), "cluster").select(
        "window_start", "eth_src", *FEATURES, "cluster", dist.alias("distance"), "is_outlier")
