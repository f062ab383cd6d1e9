"""Contract queries: grant replay and point-in-time access decisions."""

from __future__ import annotations

from skyledger.operators import access as A
from skyledger.plans.registry import register
from skyledger.sources import fixtures as fx


@register("effective_bindings", """
WITH last AS (SELECT member, resource, role, arg_max(action, seq) AS action, max(seq) AS seq
              FROM grants WHERE action IN ('add', 'remove') GROUP BY member, resource, role),
     rs AS (SELECT resource, max(seq) AS reset_seq FROM grants WHERE action = 'reset' GROUP BY resource)
SELECT l.resource, l.member, l.role, l.seq AS granted_seq
FROM last l LEFT JOIN rs ON l.resource = rs.resource
WHERE l.action = 'add' AND (rs.reset_seq IS NULL OR l.seq > rs.reset_seq)""", ("grants",))
def effective_bindings(spark, sf):
    return A.effective_bindings(fx.grants(spark, sf))


@register("access_decisions", """
WITH probe AS (SELECT a.seq AS attempt_seq, a.member, a.resource, rp.role
               FROM attempts a JOIN role_permissions rp ON a.permission = rp.permission),
     last_act AS (SELECT p.attempt_seq, p.role, arg_max(g.action, g.seq) AS action, max(g.seq) AS act_seq
                  FROM probe p JOIN grants g
                    ON g.member = p.member AND g.resource = p.resource AND g.role = p.role
                   AND g.seq < p.attempt_seq AND g.action IN ('add', 'remove')
                  GROUP BY p.attempt_seq, p.role),
     last_reset AS (SELECT a.seq AS attempt_seq, max(g.seq) AS reset_seq
                    FROM attempts a JOIN grants g
                      ON g.resource = a.resource AND g.action = 'reset' AND g.seq < a.seq
                    GROUP BY a.seq),
     dec AS (SELECT l.attempt_seq,
                    bool_or(l.action = 'add' AND (r.reset_seq IS NULL OR l.act_seq > r.reset_seq)) AS allowed
             FROM last_act l LEFT JOIN last_reset r ON l.attempt_seq = r.attempt_seq
             GROUP BY l.attempt_seq)
SELECT a.seq AS attempt_seq, a.member, a.resource, a.permission, COALESCE(d.allowed, false) AS allowed
FROM attempts a LEFT JOIN dec d ON d.attempt_seq = a.seq""", ("attempts", "grants", "role_permissions"))
def access_decisions(spark, sf):
    return A.check_access(fx.attempts(spark, sf), fx.grants(spark, sf), fx.role_permissions(spark))
