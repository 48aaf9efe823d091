"""Independent model fits submitted side by side, as Spark's own model selection does."""

from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target


def run_all(spark, jobs, parallelism=4):
    """Results of the zero-argument ``jobs`` in order; their Spark jobs share the cluster."""
    if len(jobs) == 1 or parallelism == 1:
        return [job() for job in jobs]
    pool = ThreadPool(min(parallelism, len(jobs)))
    try:
        return pool.map(lambda job: job(),
                        [inheritable_thread_target(spark)(job) for job in jobs], chunksize=1)
    finally:
        pool.close()
