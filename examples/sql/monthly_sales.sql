SELECT CAST(year(order_date) AS INT) AS order_year,
       CAST(month(order_date) AS INT) AS order_month,
       returned,
       count(*) AS order_lines,
       CAST(sum(quantity) AS BIGINT) AS quantity,
       CAST(sum(CAST(sales AS DECIMAL(18, 2))) AS DOUBLE) AS sales,
       CAST(sum(CAST(profit AS DECIMAL(18, 2))) AS DOUBLE) AS profit
FROM {orders}
GROUP BY 1, 2, 3
