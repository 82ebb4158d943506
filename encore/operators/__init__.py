"""DataFrame -> DataFrame operators.

``joins``     block lists, exclusion and semi filters (bounded broadcasts, salted hot keys), labels, cold start
``activity``  user / item activity, popularity, ordering, top-k, thresholds, cleaning, retention report
``profile``   column profiles, exact and approximate quantiles, correlation, class balance
``ordering``  distributed global running sums and row numbers
``sampling``  md5-bucket splits and stratified sampling
``indexing``  value -> index by frequency without a driver-side label array
``ranking``   top-N per group, ranked lists, ranking metrics
``evaluate``  confusion metrics, exact AUC, weighted F1 and accuracy
``features``  assemble / scale / PCA pipelines
``models``    classifiers, grids, cross-validation, ALS
``physical``  materialization, persistence, re-partitioning
"""
