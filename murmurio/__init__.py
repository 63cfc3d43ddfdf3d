"""murmurio: social-media monitoring as Spark DataFrame operators.

``functions``  Column -> Column helpers (text, time, JSON, vectors)
``operators``  DataFrame -> DataFrame building blocks
``sources``    readers and writers
``plans``      the end-to-end jobs, composed from the operators
``streaming``  the incremental jobs as Structured Streaming queries
"""
