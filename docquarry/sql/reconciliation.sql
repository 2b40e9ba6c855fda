-- Statements of the reconciliation tier; tables and values are bound by name.

-- name: replayable
SELECT doc_id, build_sha, prompt_version FROM {ledger}
WHERE state = 'failed'
  AND (build_sha IS DISTINCT FROM :build OR prompt_version IS DISTINCT FROM :prompt);

-- name: state_counts
SELECT state, count(*) AS n FROM {ledger} GROUP BY state;

-- name: stuck
SELECT doc_id, state, priority, state_updated_at FROM {ledger}
WHERE (state IN ('text_pending', 'text_running') AND state_updated_at < :text_before)
   OR (state IN ('extract_pending', 'extract_running') AND state_updated_at < :extract_before)
ORDER BY priority DESC NULLS LAST, state_updated_at ASC NULLS LAST, doc_id
LIMIT 500;

-- name: pending_triage
SELECT DISTINCT doc_id FROM {outbox} WHERE topic = :topic;
