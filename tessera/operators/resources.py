"""Executors with accelerators for the stages that run models."""

from __future__ import annotations

from pyspark.resource import ExecutorResourceRequests, ResourceProfile, ResourceProfileBuilder, TaskResourceRequests


def gpu_profile(gpus: float) -> ResourceProfile | None:
    """What a task of a model stage asks for: that many GPUs, on executors that have at least one; None for none."""
    if gpus <= 0:
        return None
    executor = ExecutorResourceRequests().resource("gpu", max(1, round(gpus)))
    return ResourceProfileBuilder().require(executor).require(TaskResourceRequests().resource("gpu", gpus)).build
