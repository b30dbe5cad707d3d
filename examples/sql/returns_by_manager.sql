SELECT r.region AS region, r.manager AS manager, o.returned AS returned,
       count(*) AS order_lines,
       CAST(sum(CAST(o.sales AS DECIMAL(18, 2))) AS DOUBLE) AS sales
FROM {orders} AS o
JOIN {customers} AS c ON o.customer_id = c.customer_id
JOIN {regions} AS r ON c.region = r.region
GROUP BY r.region, r.manager, o.returned
