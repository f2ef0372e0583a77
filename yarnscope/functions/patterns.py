"""Log formats recognised by the engine.

Fixed values: every pattern below must stay exactly as written, because the
results (which line is an attempt event, which exception is reported, which
source line) depend on the exact regular expressions, including their greedy
and find-versus-full-match behaviour. ``{c}`` is the resource-manager cluster
timestamp, ``{h}`` the host-name pattern and ``{e}`` the container epoch; they
are parameters of ``LogFormat`` because they differ between clusters. Patterns used as a full
match are anchored with ``^...$``; the others are searched (first match).
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---- fixed values: cluster defaults and record layout -----------------------
DEFAULT_CLUSTER = "1580812675067"
DEFAULT_EPOCH = r"e\d+"  # part of container ids that counts restarts of the resource manager
DEFAULT_HOST = r"iccluster\d*\.iccluster\.epfl\.ch"
RECORD_DELIMITER = "*" * 71 + "\n"
RM_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss,SSS"
DEFAULT_EXCEPTION = "org.apache.spark.SparkException"
NOT_AVAILABLE = "N/A"

# ---- fixed values: resource-manager log lines ---------------------------------
RM = {
    "info_line": r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2},\d{3} INFO  .*$",
    "has_id": r"^(?:.*application_{c}_\d*.*|.*appattempt_{c}_\d*.*|.*container_{e}_{c}_\d*.*)$",
    "app_number": r"^.*(application_{c}_|appattempt_{c}_|container_{e}_{c}_)(\d*).*$",
    "attempt_number": r"^.*(appattempt_{c}_\d*_|container_{e}_{c}_\d*_)(\d*).*$",
    "user": r"^.*user: ([a-z]*).*$",
    "final_state": r"^.*State change from [A-Z_]* to (FINISHING|FAILED|KILLED).*$",
    "container": r"^.*container_{e}_{c}_\d*_\d*_(\d*).*({h}).*$",
    "exit_status": r"^.* with final state: .*, and exit status: (-*\d*)$",
    "timestamp": r"(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2},\d{3})",
    "launch": r"^.*from [A-Z]* to LAUNCHED.*$",
}

# ---- fixed values: aggregated container-log records ---------------------------
CONTAINER_LOG = {
    "header_app": r"Container: container_{e}_{c}_(\d*)_\d*_\d* on {h}.*",
    "header_container": r"Container: container_{e}_{c}_\d*_\d*_(\d*) on ({h}).*",
    "driver_header": r"Container: container_{e}_{c}_\d*_\d*_000001 on {h}.*",
    "record_attempt": r".*(appattempt_{c}_\d*_|container_{e}_{c}_\d*_)(\d*).*",
}

# ---- fixed values: failure classification -------------------------------------
CLS = {
    "boundary": r"\n.*?=|\d{2}/\d{2}/\d{2} \d{2}:\d{2}:\d{2}",
    "class_not_found": r"(\d{2}/\d{2}/\d{2} \d{2}:\d{2}:\d{2}) ERROR ApplicationMaster: Uncaught exception: \njava.lang.ClassNotFoundException: ",
    "missing_input": r"(\d{2}/\d{2}/\d{2} \d{2}:\d{2}:\d{2}) ERROR ApplicationMaster: User class threw exception: org\.apache\.hadoop\.mapred\.InvalidInputException:([\s\S]*)?(?=\n.*?=|\d{2}/\d{2}/\d{2} \d{2}:\d{2}:\d{2})",
    "frame_line": r"at .*\(App.*:(.*)\)",
    "driver_failure": r"(\d{2}/\d{2}/\d{2} \d{2}:\d{2}:\d{2}) INFO ApplicationMaster: Final app status: .*, exitCode: \d*, \(reason: User class threw exception: (.*): .*([\s\S]*)?(?=\n.*?=|\d{2}/\d{2}/\d{2} \d{2}:\d{2}:\d{2})",
    "stage_failure": "due to stage failure",
    "cancel_stage_any": r"(\d{2}/\d{2}/\d{2} \d{2}:\d{2}:\d{2}) INFO YarnClusterScheduler: Cancelling stage (\d*)",
    "final_stage": r".*INFO DAGScheduler: Final stage: ResultStage (\d*) .* at App\d+.scala:(\d+) *",
    "max_result_size": "than spark.driver.maxResultSize",
    "block_manager": "WARN BlockManager: Failed to fetch",
    "block_manager_exc": r".*WARN BlockManager: Failed to fetch .* (.*Exception|.*Error): .*",
    "channel_handler": "WARN TransportChannelHandler:",
    "channel_handler_exc": r".*WARN TransportChannelHandler: .*\n(.*Exception|.*Error): .*",
    "result_getter": "ERROR TaskResultGetter",
    "yarn_scheduler": "ERROR YarnClusterScheduler",
    "leak_detector": "ERROR ResourceLeakDetector",
    "response_handler": "ERROR TransportResponseHandler",
    "am_error": r"\d{2}/\d{2}/\d{2} \d{2}:\d{2}:\d{2} ERROR ApplicationMaster: (.*)",
    "executor_lost_failure": "ExecutorLostFailure",
    "am_nested_exc": r"\d{2}/\d{2}/\d{2} \d{2}:\d{2}:\d{2} ERROR ApplicationMaster: User class threw exception: org.apache.spark.SparkException: .*: ([^:]*Exception):*",
    "task_set_manager": r"\d{2}/\d{2}/\d{2} \d{2}:\d{2}:\d{2} ERROR TaskSetManager: (.*)\n",
    "driver_word": "driver",
    "block_fetcher": "ERROR OneForOneBlockFetcher: Failed while starting block fetches",
    "block_fetcher_exc": r".*ERROR OneForOneBlockFetcher: Failed while starting block fetches (.*Exception|.*Error): .*",
    "short_circuit": "ERROR ShortCircuitCache",
    "short_circuit_exc": r".*ERROR ShortCircuitCache:.*\n([^:]*):*",
    "executor_error": "ERROR Executor:",
    "executor_msg": r".* ERROR Executor: (.*)",
    "utils_error_exc": r"\d{2}/\d{2}/\d{2} \d{2}:\d{2}:\d{2} ERROR Utils: .*\n([^:]*):*",
    "am_threw_exc": r".*(ERROR|INFO) ApplicationMaster: .* threw exception: (.*Exception):.*",
    "error_actor": r"\d{2}/\d{2}/\d{2} \d{2}:\d{2}:\d{2} ERROR (\w*):*",
    "utils_actor": "Utils",
    "scheduler_actor": "YarnClusterScheduler",
    "lost_executor": r"\d{2}/\d{2}/\d{2} \d{2}:\d{2}:\d{2} ERROR YarnClusterScheduler: Lost executor \d* on {h}: Container marked as failed: container_{e}_{c}_\d{4,}_\d{2,}_(\d{6})*",
    "executor_exc": r"\d{2}/\d{2}/\d{2} \d{2}:\d{2}:\d{2} ERROR Executor: .*\n([^:]*):.*\n.*at (.*)\n",
    "user_code_marker": "App",
    "app_line": r"App\d*.scala:(\d*)",
    "utils_info_exc": r"\d{2}/\d{2}/\d{2} \d{2}:\d{2}:\d{2} INFO Utils: .*\n([^:]*):*",
    "am_user_exc": r"\d{2}/\d{2}/\d{2} \d{2}:\d{2}:\d{2} ERROR ApplicationMaster: User class threw exception: ([^:]*):*",
    "dag_failed": r"\d{2}/\d{2}/\d{2} \d{2}:\d{2}:\d{2} INFO DAGScheduler: .* \(.* at App\d*.scala:(\d*)\) failed *",
    "cancel_stage": r"\d{2}/\d{2}/\d{2} \d{2}:\d{2}:\d{2} INFO YarnClusterScheduler: Cancelling stage (\d*)",
    "any_error": r"\d{2}/\d{2}/\d{2} \d{2}:\d{2}:\d{2} ERROR",
    "generic_stage": r"stage (\d+)",
    "generic_exc": r"((java\.[^(\s|$)]*(Exception|Error)|org\.apache\.spark\.[^(\s|$)]*(Exception|Error)))",
    "generic_line": r"(\d{2}/\d{2}/\d{2} \d{2}:\d{2}:\d{2} INFO DAGScheduler: .* \(.* at App\d*.scala:(\d*)\) failed|App\d+\$.main\(App\d*.scala:(\d+)\)|App\d+.scala:(\d+)\) failed)",
}

# ---- fixed values: failure report --------------------------------------------
REPORT = {
    "block": r"^\s*:\s*(appattempt_{c}_\d+_\d+)\s+User\s*:\s*([a-z]+)\s+StartTime\s*:\s*(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2},\d{3})\s+EndTime\s*:\s*(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2},\d{3})\s+Containers\s*:\s*([^:]*?)\s+ErrorCategory\s*:\s*(-?\d+)\s+Exception\s*:\s*(N/A|(?:[a-zA-Z_$][a-zA-Z\d_$]*\.)*[a-zA-Z_$][a-zA-Z\d_$]*)\s+Stage\s*:\s*(-?\d+)\s+SourceCodeLine\s*:\s*(-?\d+)\s*$",
    "container_pair": r"^\s*(container_{e}_{c}_\d+_\d+_\d+)\s*->\s*({h})\s*$",
    "block_keyword": "AppAttempt",
    "attempt_ref": r"appattempt_{c}_\d+_\d+",
}


@dataclass(frozen=True)
class LogFormat:
    """The patterns instantiated for one cluster."""

    cluster: str = DEFAULT_CLUSTER
    host: str = DEFAULT_HOST
    epoch: str = DEFAULT_EPOCH
    rm: dict = field(init=False)
    container_log: dict = field(init=False)
    cls: dict = field(init=False)
    report: dict = field(init=False)

    def __post_init__(self):
        def fill(d):
            return {k: v.replace("{c}", self.cluster).replace("{h}", self.host).replace("{e}", self.epoch) for k, v in d.items()}
        object.__setattr__(self, "rm", fill(RM))
        object.__setattr__(self, "container_log", fill(CONTAINER_LOG))
        object.__setattr__(self, "cls", fill(CLS))
        object.__setattr__(self, "report", fill(REPORT))


DEFAULT_FORMAT = LogFormat()
