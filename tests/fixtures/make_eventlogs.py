"""Write the two small event-log fixtures used by the runlog tests.

Run from the repository root: ``python tests/fixtures/make_eventlogs.py``.
The records follow Spark's JSON event-log layout (one event per line);
values are chosen so the expected answers are easy to state by hand.
"""

import json
import os

HERE = os.path.dirname(os.path.abspath(__file__))
GB = 1024 ** 3
MB = 1024 ** 2


def task(stage, tid, launch, ms, executor="1", *, gc=5, peak=64 * MB, mem_spill=0, disk_spill=0,
         read=0, write=0, records=1000, failed=False):
    reason = {"Reason": "Success"} if not failed else {
        "Reason": "ExceptionFailure", "Class Name": "java.lang.OutOfMemoryError",
        "Description": "Java heap space", "Stack Trace": [], "Accumulator Updates": []}
    return {"Event": "SparkListenerTaskEnd", "Stage ID": stage, "Stage Attempt ID": 0,
            "Task Type": "ShuffleMapTask" if stage == 0 else "ResultTask", "Task End Reason": reason,
            "Task Info": {"Task ID": tid, "Index": tid, "Attempt": 0, "Partition ID": tid,
                          "Launch Time": launch, "Executor ID": executor, "Host": f"host-{executor}",
                          "Locality": "PROCESS_LOCAL", "Speculative": False, "Getting Result Time": 0,
                          "Finish Time": launch + ms, "Failed": failed, "Killed": False},
            "Task Metrics": {"Executor Deserialize Time": 1, "Executor Run Time": ms - 2,
                             "Executor CPU Time": (ms - 2) * 1_000_000, "Peak Execution Memory": peak,
                             "Result Size": 2000, "JVM GC Time": gc, "Result Serialization Time": 0,
                             "Memory Bytes Spilled": mem_spill, "Disk Bytes Spilled": disk_spill,
                             "Shuffle Read Metrics": {"Remote Blocks Fetched": 0, "Local Blocks Fetched": 1,
                                                      "Fetch Wait Time": 0, "Remote Bytes Read": read // 2,
                                                      "Remote Bytes Read To Disk": 0,
                                                      "Local Bytes Read": read - read // 2,
                                                      "Total Records Read": records if stage else 0},
                             "Shuffle Write Metrics": {"Shuffle Bytes Written": write, "Shuffle Write Time": 1000,
                                                       "Shuffle Records Written": records if stage == 0 else 0},
                             "Input Metrics": {"Bytes Read": 4 * MB if stage == 0 else 0,
                                               "Records Read": records if stage == 0 else 0},
                             "Output Metrics": {"Bytes Written": 0, "Records Written": 0},
                             "Updated Blocks": []}}


def log(name, app_id, start, stage0_ms, stage1, failed_task):
    ev = [{"Event": "SparkListenerLogStart", "Spark Version": "4.1.2"},
          {"Event": "SparkListenerBlockManagerAdded",
           "Block Manager ID": {"Executor ID": "1", "Host": "host-1", "Port": 7001},
           "Maximum Memory": 1 * GB, "Timestamp": start, "Maximum Onheap Memory": 1 * GB,
           "Maximum Offheap Memory": 0},
          {"Event": "SparkListenerBlockManagerAdded",
           "Block Manager ID": {"Executor ID": "2", "Host": "host-2", "Port": 7002},
           "Maximum Memory": 1 * GB, "Timestamp": start, "Maximum Onheap Memory": 1 * GB,
           "Maximum Offheap Memory": 0},
          {"Event": "SparkListenerApplicationStart", "App Name": name, "App ID": app_id,
           "Timestamp": start, "User": "tester"}]
    t = start + 1000
    tid = 0
    for i, ms in enumerate(stage0_ms):                    # stage 0: 8 map tasks
        ev.append(task(0, tid, t, ms, executor=str(1 + i % 2), write=10 * MB))
        tid += 1
    ev.append({"Event": "SparkListenerJobEnd", "Job ID": 0, "Completion Time": t + max(stage0_ms),
               "Job Result": {"Result": "JobSucceeded"}})
    t += max(stage0_ms) + 100
    for i, spec in enumerate(stage1):                     # stage 1: 4 reduce tasks
        ev.append(task(1, tid, t, spec["ms"], executor=str(1 + i % 2), read=20 * MB, **spec["kw"]))
        tid += 1
    if failed_task:
        ev.append(task(1, tid, t, 50, executor="2", read=0, records=0, failed=True))
    end = t + max(s["ms"] for s in stage1) + 100
    ev.append({"Event": "SparkListenerJobEnd", "Job ID": 1, "Completion Time": end - 50,
               "Job Result": {"Result": "JobSucceeded"}})
    ev.append({"Event": "SparkListenerApplicationEnd", "Timestamp": end, "ExitCode": 0})
    return ev


def main():
    before = log("clickstream-rollup", "app-before", 1_700_000_000_000,
                 [100, 100, 100, 100, 100, 100, 100, 1500],
                 [{"ms": 400, "kw": {"peak": 950 * MB, "mem_spill": 300 * MB, "disk_spill": 120 * MB, "gc": 120}},
                  {"ms": 300, "kw": {"peak": 200 * MB}},
                  {"ms": 300, "kw": {"peak": 200 * MB}},
                  {"ms": 300, "kw": {"peak": 200 * MB}}],
                 failed_task=True)
    after = log("clickstream-rollup", "app-after", 1_700_000_100_000,
                [120, 120, 120, 120, 120, 120, 120, 150],
                [{"ms": 200, "kw": {"peak": 300 * MB}},
                 {"ms": 200, "kw": {"peak": 300 * MB}},
                 {"ms": 200, "kw": {"peak": 300 * MB}},
                 {"ms": 200, "kw": {"peak": 300 * MB}}],
                failed_task=False)
    for name, ev in (("eventlog_before.jsonl", before), ("eventlog_after.jsonl", after)):
        with open(os.path.join(HERE, name), "w") as f:
            for e in ev:
                f.write(json.dumps(e) + "\n")
    # The "before" log again, rolled into two files of one application folder.
    rolled = os.path.join(HERE, "eventlog_v2_app-before")
    os.makedirs(rolled, exist_ok=True)
    half = len(before) // 2
    for i, part in enumerate((before[:half], before[half:]), start=1):
        with open(os.path.join(rolled, f"events_{i}_app-before"), "w") as f:
            for e in part:
                f.write(json.dumps(e) + "\n")


if __name__ == "__main__":
    main()
