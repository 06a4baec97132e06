"""tessera: prepare, profile and cluster wide numeric tables on Spark.

Entry points by stage (each a DataFrame -> DataFrame function unless noted):

* sources: ``tessera.sources.load_products``, ``read_json``, ``read_delimited``,
  ``read_parquet``, ``read_table``, ``materialize``, ``save_model``, ``write_report``
* quality: ``tessera.operators.quality.clean_table`` and its parts
* profile: ``tessera.operators.profile.summary_stats``, ``quantiles``, ``word_count``
* features: ``tessera.operators.features.outlier_trim``, ``assemble_scale``
* clustering: ``tessera.operators.clustering.kmeans_sweep``, ``choose_k``,
  ``fit_kmeans``, ``assign_nearest``, ``wssse``, ``silhouette``
* analysis: ``tessera.operators.evaluate.cluster_profile``, ``cluster_sizes``,
  ``minmax_normalise``, ``cluster_report``; ``tessera.operators.pca.pca_points``
* whole job: ``tessera.plans.job.ingest`` (raw → clean table), ``run_job``
* streaming: ``tessera.streaming.clean_stream``
"""

__version__ = "0.1.0"
