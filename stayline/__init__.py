"""Spark-native user-activity and churn analytics.

``sources``    readers, writers and adapters that yield the activity-log schema
``functions``  column expressions (time, ratios, user agents, hashing)
``operators``  DataFrame -> DataFrame building blocks
``plans``      complete batch jobs: featurize, train, search, score, monitor
``streaming``  incremental ingest of new log files
``registry``   the registered queries and their SQL counterparts
"""
