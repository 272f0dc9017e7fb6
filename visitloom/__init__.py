"""Session analytics over e-commerce click-streams, as typed Spark DataFrame operators.

Every operator is a lazy ``DataFrame -> DataFrame`` function; only the sinks
and :func:`visitloom.plans.job.run` start Spark jobs.
"""
