-- Sessions and sessions with a purchase by day of the first event.
SELECT to_date(first_seen_at) AS day, count(*) AS sessions, sum(purchased) AS purchases
FROM fct_sessions
GROUP BY to_date(first_seen_at)
