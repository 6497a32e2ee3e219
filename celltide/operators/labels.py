"""Label rule sets used by the platform's log and metric collectors.

The rules are data (``celltide.functions.relabel.Rule``); ``relabel`` turns
them into built-in map expressions.
"""

from __future__ import annotations

from celltide.functions.relabel import Rule

# Pod log target rules of the log collector.
POD_LOG_RULES = [
    Rule(source_labels=("__meta_kubernetes_namespace",), target_label="namespace"),
    Rule(source_labels=("__meta_kubernetes_pod_name",), target_label="pod"),
    Rule(source_labels=("__meta_kubernetes_pod_container_name",), target_label="container"),
    Rule(source_labels=("__meta_kubernetes_pod_label_app_kubernetes_io_name",), target_label="app"),
    Rule(source_labels=("__meta_kubernetes_namespace", "__meta_kubernetes_pod_container_name"),
         separator="/", replacement="$1", target_label="job"),
    Rule(source_labels=("__meta_kubernetes_pod_uid", "__meta_kubernetes_pod_container_name"),
         separator="/", replacement="/var/log/pods/*$1/*.log", target_label="__path__"),
    Rule(source_labels=("__meta_kubernetes_pod_container_id",), regex=r"^(\S+):\/\/.+$",
         replacement="$1", target_label="container_runtime"),
]

# Constant address label of the node scrape jobs.
CONSTANT_ADDRESS_RULE = Rule(replacement="kubernetes.default.svc:443", target_label="__address__")

# Address rewrite with a port annotation.
ADDRESS_PORT_RULE = Rule(source_labels=("__address__", "__meta_kubernetes_service_annotation_prometheus_io_port"),
                         regex=r"(.+?)(?::\d+)?;(\d+)", replacement="$1:$2", target_label="__address__")

# Pods that are not running are dropped.
DROP_FINISHED_PODS = Rule(action="drop", source_labels=("__meta_kubernetes_pod_phase",),
                          regex="Pending|Succeeded|Failed|Completed")

# Pod labels become target labels.
POD_LABELMAP = Rule(action="labelmap", regex="__meta_kubernetes_pod_label_(.+)")
NODE_LABELMAP = Rule(action="labelmap", regex="__meta_kubernetes_node_label_(.+)")

# Only the API server's secure endpoint is kept.
KEEP_API_SERVER = Rule(action="keep", source_labels=("__meta_kubernetes_namespace", "__meta_kubernetes_service_name", "__meta_kubernetes_endpoint_port_name"),
                       regex="default;kubernetes;https")

# Targets of the node metrics job.
NODE_METRICS_RULES = [
    NODE_LABELMAP,
    CONSTANT_ADDRESS_RULE,
    Rule(source_labels=("__meta_kubernetes_node_name",), regex="(.+)", replacement="/api/v1/nodes/$1/proxy/metrics", target_label="__metrics_path__"),
]

# Targets of the annotated service endpoints.
SERVICE_ENDPOINT_RULES = [
    Rule(action="keep", source_labels=("__meta_kubernetes_service_annotation_prometheus_io_scrape",), regex="true"),
    Rule(action="drop", source_labels=("__meta_kubernetes_service_annotation_prometheus_io_scrape_slow",), regex="true"),
    Rule(source_labels=("__meta_kubernetes_service_annotation_prometheus_io_scheme",), regex="(https?)", target_label="__scheme__"),
    Rule(source_labels=("__meta_kubernetes_service_annotation_prometheus_io_path",), regex="(.+)", target_label="__metrics_path__"),
    ADDRESS_PORT_RULE,
]
