"""Reference dimension of the tracked cities."""

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "city string, country string, latitude double, longitude double"

# City, country, latitude, longitude.
CITIES = """
New York,US,40.7128,-74.0060
Los Angeles,US,34.0522,-118.2437
Chicago,US,41.8781,-87.6298
Miami,US,25.7617,-80.1918
London,GB,51.5074,-0.1278
Tokyo,JP,35.6762,139.6503
Sydney,AU,-33.8688,151.2093
Sao Paulo,BR,-23.5505,-46.6333
Houston,US,29.7604,-95.3698
Phoenix,US,33.4484,-112.074
Philadelphia,US,39.9526,-75.1652
San Antonio,US,29.4241,-98.4936
San Diego,US,32.7157,-117.1611
Dallas,US,32.7767,-96.797
San Jose,US,37.3382,-121.8863
Austin,US,30.2672,-97.7431
Jacksonville,US,30.3322,-81.6557
Fort Worth,US,32.7555,-97.3308
Columbus,US,39.9612,-82.9988
Charlotte,US,35.2271,-80.8431
San Francisco,US,37.7749,-122.4194
Indianapolis,US,39.7684,-86.1581
Seattle,US,47.6062,-122.3321
Denver,US,39.7392,-104.9903
Washington,US,38.9072,-77.0369
Boston,US,42.3601,-71.0589
El Paso,US,31.7619,-106.485
Nashville,US,36.1627,-86.7816
Detroit,US,42.3314,-83.0458
Oklahoma City,US,35.4676,-97.5164
Portland,US,45.5152,-122.6784
Las Vegas,US,36.1699,-115.1398
Memphis,US,35.1495,-90.049
Louisville,US,38.2527,-85.7585
Baltimore,US,39.2904,-76.6122
Milwaukee,US,43.0389,-87.9065
Albuquerque,US,35.0844,-106.6504
Tucson,US,32.2226,-110.9747
Fresno,US,36.7378,-119.7871
Sacramento,US,38.5816,-121.4944
Kansas City,US,39.0997,-94.5786
Mesa,US,33.4152,-111.8315
Atlanta,US,33.749,-84.388
Omaha,US,41.2565,-95.9345
Colorado Springs,US,38.8339,-104.8214
Raleigh,US,35.7796,-78.6382
Long Beach,US,33.7701,-118.1937
Virginia Beach,US,36.8529,-75.978
Oakland,US,37.8044,-122.2712
Minneapolis,US,44.9778,-93.265
Tulsa,US,36.154,-95.9928
Tampa,US,27.9506,-82.4572
Arlington,US,32.7357,-97.1081
New Orleans,US,29.9511,-90.0715
"""


def cities(spark: SparkSession) -> DataFrame:
    rows = []
    for line in CITIES.strip().splitlines():
        city, country, latitude, longitude = line.split(",")
        rows.append((city, country, float(latitude), float(longitude)))
    return spark.createDataFrame(rows, SCHEMA)
