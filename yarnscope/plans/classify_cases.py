"""Container-log cases for the classifier plan and tests.

Each case is the body of the driver record (container 1) and, when present,
of one executor record (container 2), with the expected diagnosis
``(category, exception, stage, source_line)``. ``{T}`` is a log timestamp
(``yy/MM/dd HH:mm:ss``), ``{A}`` the four-digit application number and
``{N2}`` the two-digit attempt number.
"""

from __future__ import annotations

FS = "{T} INFO DAGScheduler: Final stage: ResultStage 0 (collect at App14.scala:31)"
U = "{T} ERROR Utils: Uncaught exception in thread task-result-getter-0\njava.lang.OutOfMemoryError: Java heap space"
LOST = ("{T} ERROR YarnClusterScheduler: Lost executor 1 on iccluster048.iccluster.epfl.ch: Container marked as "
        "failed: container_e02_{C}_{A}_{N2}_000002 on host: iccluster048.iccluster.epfl.ch.")
CS = "{T} INFO YarnClusterScheduler: Cancelling stage 1"
AM = ("{T} INFO ApplicationMaster: Final app status: FAILED, exitCode: 15, (reason: User class threw exception: "
      "java.lang.OutOfMemoryError: GC overhead limit exceeded")
EX = "{T} ERROR Executor: Exception in task 0.3 in stage 1.0 (TID 3)\njava.lang.OutOfMemoryError: Java heap space"
END = ")\n{T} INFO ShutdownHookManager: bye"
OOM = "java.lang.OutOfMemoryError"
IOE = "java.io.IOException"
SPARK = "org.apache.spark.SparkException"

# (name, driver body, executor body or None, expected)
CASES = [
    ("class_not_found",
     "{T} ERROR ApplicationMaster: Uncaught exception: \njava.lang.ClassNotFoundException: App77", None,
     (1, "java.lang.ClassNotFoundException", -1, -1)),
    ("missing_input",
     "{T} ERROR ApplicationMaster: User class threw exception: org.apache.hadoop.mapred.InvalidInputException: "
     "Input path does not exist\n\tat App11$.main(App11.scala:52)\n{T} INFO X: y", None,
     (2, "org.apache.hadoop.mapred.InvalidInputException", -1, 52)),
    ("driver_code", CS + "\n" + AM + "\n\tat App13$.main(App13.scala:38)\n" + END, None, (3, OOM, 1, 38)),
    ("driver_code_framework_frame",
     AM + "\n\tat org.apache.spark.deploy.yarn.ApplicationMaster$$anon$4.run(ApplicationMaster.scala:555)\n" + END,
     None, (3, OOM, -1, 555)),
    ("driver_code_no_boundary", AM + "\n\tat App13$.main(App13.scala:38)\n)", None, (9, "N/A", -1, -1)),
    ("max_result_size",
     FS + "\n{T} WARN TaskSetManager: Total size of results is bigger than spark.driver.maxResultSize", None,
     (4, SPARK, 0, 31)),
    ("block_manager_fetch",
     FS + "\n{T} WARN BlockManager: Failed to fetch block after 1 fetch failures java.io.IOException: Failed to connect",
     None, (4, IOE, 0, 31)),
    ("transport_channel",
     FS + "\n{T} WARN TransportChannelHandler: Exception in connection from /10.0.0.1\n"
     "java.io.IOException: Connection reset by peer", None, (4, IOE, 0, 31)),
    ("task_result_getter", FS + "\n" + U + "\n{T} ERROR TaskResultGetter: Exception while getting task result",
     None, (4, OOM, 0, 31)),
    ("response_handler", FS + "\n" + U + "\n{T} ERROR TransportResponseHandler: Still have 1 requests outstanding",
     None, (4, OOM, 0, 31)),
    ("nested_driver_exception",
     FS + "\n{T} ERROR ApplicationMaster: User class threw exception: org.apache.spark.SparkException: "
     "Job aborted: java.io.IOException: x", None, (4, IOE, 0, 31)),
    ("task_set_manager_driver",
     FS + "\n{T} ERROR TaskSetManager: Task 0 lost contact with driver\n"
     "{T} ERROR ApplicationMaster: User class threw exception: org.apache.spark.SparkException: lost", None,
     (4, SPARK, 0, 31)),
    ("executor_block_fetch", FS,
     "{T} ERROR OneForOneBlockFetcher: Failed while starting block fetches\njava.io.IOException: reset",
     (4, IOE, 0, 31)),
    ("executor_short_circuit", FS, "{T} ERROR ShortCircuitCache: failed to release\njava.io.IOException: x",
     (4, IOE, 0, 31)),
    ("executor_heartbeat", FS,
     "{T} ERROR Executor: Exit as unable to send heartbeats to driver more than 60 times", (4, SPARK, 0, 31)),
    ("executor_user_code", LOST + "\n" + CS, EX + "\n\tat App11$$anonfun$2.apply(App11.scala:64)", (5, OOM, 1, 64)),
    ("executor_framework_code", LOST + "\n" + CS,
     EX + "\n\tat java.util.Arrays.copyOf(Arrays.java:1201)\n\tat App16$$anonfun$1.apply(App16.scala:47)",
     (6, OOM, 1, 47)),
    ("executor_no_stage", LOST, EX + "\n\tat java.util.Arrays.copyOf(Arrays.java:1201)", (7, SPARK, -1, -1)),
    ("other_driver_error",
     "{T} ERROR AsyncEventQueue: dropped org.apache.spark.SparkException: x stage 12 stage 0 "
     "java.io.IOException: y\n{T} INFO DAGScheduler: ResultStage 1 (collect at App17.scala:83) failed in 3 s", None,
     (7, IOE, 12, 83)),
    ("other_executor_error", FS, "{T} ERROR CoarseGrainedExecutorBackend: RECEIVED SIGNAL TERM", (8, SPARK, -1, -1)),
    ("unknown", FS, None, (9, "N/A", -1, -1)),
]

DRIVER_FILLER = "{T} INFO SignalUtils: Registered signal handler for TERM\n{T} INFO ApplicationMaster: Preparing Local resources\n"
EXECUTOR_FILLER = "{T} INFO Executor: Starting executor ID 2 on host localhost\n"
IDLE_EXECUTOR = "{T} INFO MemoryStore: MemoryStore started with capacity 366.3 MB\n{T} INFO Executor: Told to shut down\n"
#: Categories that the first driver record decides; the last one decides the others.
FIRST_DECIDES = (1, 3)
#: A driver record of another diagnosis (category 4) for every case: it counts as the last record only.
DRIVER_DECOY = "{T} INFO DAGScheduler: Final stage: ResultStage 9 (collect at App19.scala:91)\n{T} WARN TaskSetManager: Total size of results is bigger than spark.driver.maxResultSize\n"
