"""Policy and topology documents declared in the lab scripts.

FIXED VALUES — these must equal the declared settings for results to match:
firewall rules, subnets, the request security policy, the lifecycle policy,
the backend service settings, health-check thresholds and the role to
permission table. They are configuration documents (tens of rows), never
data that grows; operators check their size before embedding them.
"""

from __future__ import annotations

import json

# ---------------------------------------------------------------- FIXED VALUES
# Firewall rules: name, network, direction, priority, action, rules spec,
# source ranges, target tags (empty list = applies to all instances).
FIREWALL_RULES = [
    ("fw-allow-health-checks", "default", "INGRESS", 1000, "ALLOW", "tcp:80",
     ["130.211.0.0/22", "35.191.0.0/16"], ["allow-health-checks"]),
    ("minecraft-rule", "default", "INGRESS", 1000, "ALLOW", "tcp:25565",
     ["0.0.0.0/0"], ["minecraft-server"]),
    ("allow-http", "default", "INGRESS", 1000, "ALLOW", "tcp:80",
     ["0.0.0.0/0"], ["http-server"]),
    ("allow-https", "default", "INGRESS", 1000, "ALLOW", "tcp:443",
     ["0.0.0.0/0"], ["https-server"]),
    ("mynetwork-allow-icmp", "mynetwork", "INGRESS", 65534, "ALLOW", "icmp",
     ["0.0.0.0/0"], []),
    ("mynetwork-allow-custom", "mynetwork", "INGRESS", 65534, "ALLOW", "all",
     ["10.128.0.0/9"], []),
    ("mynetwork-allow-rdp", "mynetwork", "INGRESS", 65534, "ALLOW", "tcp:3389",
     ["0.0.0.0/0"], []),
    ("mynetwork-allow-ssh", "mynetwork", "INGRESS", 65534, "ALLOW", "tcp:22",
     ["0.0.0.0/0"], []),
    ("allow-iap-ssh", "mynetwork", "INGRESS", 1000, "ALLOW", "tcp:22",
     ["35.235.240.0/20"], ["iap-gce"]),
    ("managementnet-allow-icmp-ssh-rdp", "managementnet", "INGRESS", 1000, "ALLOW",
     "icmp,tcp:22,tcp:3389", ["0.0.0.0/0"], []),
    ("privatenet-allow-icmp-ssh-rdp", "privatenet", "INGRESS", 1000, "ALLOW",
     "icmp,tcp:22,tcp:3389", ["0.0.0.0/0"], []),
]

# Subnets: name, network, region, range. The auto-mode network uses the
# documented per-region ranges inside 10.128.0.0/9.
SUBNETS = [
    ("mynetwork-us", "mynetwork", "us-east4", "10.150.0.0/20"),
    ("mynetwork-notus", "mynetwork", "asia-southeast1", "10.148.0.0/20"),
    ("managementsubnet-us", "managementnet", "us-east4", "10.240.0.0/20"),
    ("privatesubnet-us", "privatenet", "us-east4", "172.16.0.0/24"),
    ("privatesubnet-notus", "privatenet", "asia-southeast1", "172.20.0.0/20"),
]

# Role -> permission, as the permission probes of the access lab show
# (object viewer reads and lists, object creator writes, neither lists VMs).
ROLE_PERMISSIONS = [
    ("roles/storage.objectViewer", "storage.objects.get"),
    ("roles/storage.objectViewer", "storage.objects.list"),
    ("roles/storage.objectCreator", "storage.objects.create"),
    ("roles/viewer", "storage.objects.list"),
    ("roles/viewer", "compute.instances.list"),
    ("roles/compute.instanceAdmin.v1", "compute.instances.list"),
    ("roles/iam.serviceAccountUser", "iam.serviceAccounts.actAs"),
]

# Request security policy: allow-all at the lowest precedence, a per-IP
# throttle (500 requests per 60 s, excess denied with 403) just above it.
SECURITY_POLICY_JSON = json.dumps({
    "description": "Default security policy for: http-backend",
    "name": "default-security-policy-for-backend-service-http-backend",
    "rules": [
        {"action": "allow",
         "match": {"config": {"srcIpRanges": ["*"]}, "versionedExpr": "SRC_IPS_V1"},
         "priority": 2147483647},
        {"action": "throttle",
         "description": "Default rate limiting rule",
         "match": {"config": {"srcIpRanges": ["*"]}, "versionedExpr": "SRC_IPS_V1"},
         "priority": 2147483646,
         "rateLimitOptions": {"conformAction": "allow", "enforceOnKey": "IP",
                              "exceedAction": "deny(403)",
                              "rateLimitThreshold": {"count": 500, "intervalSec": 60}}},
    ],
})

# Object lifecycle policy: delete objects 31 days after creation.
LIFECYCLE_POLICY_JSON = json.dumps(
    {"rule": [{"action": {"type": "Delete"}, "condition": {"age": 31}}]})

# Backend service: capacity and cache-key settings.
BACKEND_SERVICE_JSON = json.dumps({
    "name": "http-backend",
    "backends": [
        {"balancingMode": "RATE", "capacityScaler": 1.0, "group": "us-1-mig",
         "maxRatePerInstance": 50.0},
        {"balancingMode": "UTILIZATION", "capacityScaler": 1.0, "group": "notus-1-mig",
         "maxUtilization": 0.8},
    ],
    "cdnPolicy": {"cacheKeyPolicy": {"includeHost": True, "includeProtocol": True,
                                     "includeQueryString": True},
                  "cacheMode": "CACHE_ALL_STATIC", "clientTtl": 3600,
                  "defaultTtl": 3600, "maxTtl": 86400},
    "logConfig": {"enable": True, "sampleRate": 1.0},
})

# Health check and autoscaler settings.
HEALTH_CHECK = {"check_interval_s": 5, "timeout_s": 5,
                "unhealthy_threshold": 2, "healthy_threshold": 2,
                "initial_delay_s": 60}
AUTOSCALER = {"target_utilization": 0.8, "max_rate_per_instance": 50.0,
              "capacity_scaler": 1.0, "min_replicas": 1, "max_replicas": 2}

# Project metadata keys for the default zone and region.
METADATA_ZONE_KEY = "google-compute-default-zone"
METADATA_REGION_KEY = "google-compute-default-region"

# Derived resource names: backup bucket suffix, service account name and domain.
BACKUP_BUCKET_SUFFIX = "-backup"
SERVICE_ACCOUNT_NAME = "bucket-reader"
SERVICE_ACCOUNT_DOMAIN = ".iam.example.com"

# Dataset default.
DATASET_DEFAULT_TTL_S = 86400
SNAPSHOT_EVERY = "4 hours"
# ------------------------------------------------------------ END FIXED VALUES


def throttle(policy_json: str = SECURITY_POLICY_JSON) -> dict:
    """The throttle rule of a request policy: count, interval, exceed action, and its priority."""
    rule = min((r for r in json.loads(policy_json)["rules"] if r.get("rateLimitOptions")),
               key=lambda r: r["priority"])
    options = rule["rateLimitOptions"]
    return {"count": options["rateLimitThreshold"]["count"],
            "interval_s": options["rateLimitThreshold"]["intervalSec"],
            "exceed_action": options["exceedAction"], "priority": rule["priority"]}


RATE_LIMIT = throttle()
