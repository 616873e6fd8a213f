-- Days with at least as many sessions as the average day.
SELECT day, sessions, purchases
FROM session_days
WHERE sessions >= (SELECT avg(sessions) FROM session_days);
