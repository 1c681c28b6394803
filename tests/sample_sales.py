"""The small sales files of the golden tests, as raw CSV rows."""

HEADER = ("id_venta,fecha,id_cliente,id_producto,cantidad,precio_unitario,canal,ciudad,"
          "vendedor,email_cliente,telefono_cliente")

INITIAL = """\
1001,2024-01-05,2001,501,2,35000,Online,Bogotá,Juan Pérez,juan.cliente@email.com,3001234567
1002,2024-01-05,2002,502,1,45000,Tienda,Bogotá,Ana Torres,maria.gomez@email.com,3009876543
1003,2024/01/06,2003,503,3,15000,online,Medellín,,carlos.ruiz@email.com,3102345678
1004,2024-01-07,2004,504,1,,Tienda,Cali,Laura Díaz,laura.santos@email.com,3156789012
1005,2024-13-07,2005,501,2,35000,Online,Bogotá,Juan Pérez,pedro.diaz@email.com,3161234567
1006,2024-01-08,2001,502,5,45000,Online,Bogotá,Juan Pérez,juan.cliente@email.com,3001234567
1007,2024-01-08,2006,505,1,25000,Tienda,Cali,Laura Díaz,sofia.lopez@email.com,3201234567
1008,2024-01-09,2007,501,-2,35000,Online,Medellín,Camilo Rojas,andres.mejia@email.com,3111234567
1009,2024-01-09,2002,506,3,55000,marketplace,Bogotá,Ana Torres,maria.gomez@email.com,3009876543
1010,2024-01-10,2008,503,2,15000,Tienda,Barranquilla,Roberto Vega,diana.herrera@email.com,3176543210
1011,2024-01-10,2009,507,1,80000,Online,Bogotá,Juan Pérez,miguel.torres@email.com,3145678901
1012,2024-01-11,2003,502,4,45000,Online,Medellín,,carlos.ruiz@email.com,3102345678
1013,2024-01-11,2010,508,2,30000,Tienda,Cali,Laura Díaz,isabella.mora@email.com,3209876543
1014,2024-01-12,2011,501,1,35000,Marketplace,Bogotá,Juan Pérez,daniel.rivera@email.com,3134567890
1015,2024-01-12,2004,509,3,20000,online,Cali,Laura Díaz,laura.santos@email.com,3156789012
1016,2024-01-13,2012,510,5,12000,Tienda,Medellín,Camilo Rojas,valentina.garcia@email.com,3198765432
1017,2024-01-13,2001,503,2,15000,Online,Bogotá,Juan Pérez,juan.cliente@email.com,3001234567
1018,2024-01-14,2013,502,1,45000,Tienda,Barranquilla,Roberto Vega,santiago.mendez@email.com,3112345678
1019,2024-01-14,2014,504,3,22000,Online,Cali,Laura Díaz,camila.ortiz@email.com,3187654321
1020,2024-01-14,2015,501,2,35000,Marketplace,Medellín,Camilo Rojas,nicolas.ramirez@email.com,3176543210
"""

INCREMENTAL = """\
1021,2024-01-15,2001,501,1,35000,Online,Bogotá,Juan Pérez,juan.cliente@email.com,3001234567
1022,2024/01/15,2017,503,2,15000,Online,Cali,,lucia.morales@email.com,3145678902
1023,2024-01-16,2018,510,3,30000,Tienda,Medellín,Laura Díaz,fernanda.silva@email.com,3198765433
1024,2024-01-16,2002,511,1,95000,Online,Bogotá,Ana Torres,maria.gomez@email.com,3009876543
1015,2024-01-12,2004,509,3,20000,Online,Cali,Laura Díaz,laura.santos@email.com,3156789012
1025,2024-01-17,2019,502,2,45000,Marketplace,Cartagena,Roberto Vega,joaquin.castro@email.com,3187654322
1026,2024-01-17,2005,504,1,,Tienda,Bogotá,Juan Pérez,pedro.diaz@email.com,3161234567
1027,2024-01-18,2020,501,4,35000,Online,Bogotá,Juan Pérez,gabriela.nunez@email.com,3209876544
1028,2024/01/18,2021,503,2,15000,Online,Medellín,,ricardo.vargas@email.com,3134567891
"""


def write_csv(folder, name, rows):
    path = folder / name
    path.write_text(HEADER + "\n" + rows, encoding="utf-8")
    return str(path)
